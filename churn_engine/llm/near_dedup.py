"""Near-duplicate texts: improved consistent weighted sampling over TF-IDF shingles, banded, verified by weighted Jaccard.

A shingle is five words (A-Z folded); a text of one to four words has one shingle, all its words. Its weight is how
often it occurs in the text times the mean inverse document frequency of its words. Document frequencies are taken
over all texts, in a table of ``SLOTS`` word hashes: what is sent to the tasks has a fixed size, and two words in one
slot only share a weight. Frequencies of words rather than of whole shingles keep large groups together: a shingle
that thousands of near copies share would otherwise weigh so little that one edit splits the group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churn_engine.llm import words
from churn_engine.llm.common import components, in_slices, pack, pieces, ranges, small_batches, store, text_bytes, unpacked, unused

SHINGLE = 5
SIMILARITY = 0.8
#: Bands and samples per band. At similarity 0.8 a pair is missed with probability (1 - 0.8**3)**10 < 0.001.
BANDS, ROWS = 10, 3
SLOTS = 1 << 20
#: Entries of the table of random variables; each sample draws a shingle's entry by its hash.
DRAWS = 1 << 16
#: 64-bit blocks of the filter that spares texts an exchange: 2 MB whatever the corpus.
BLOOM_BLOCKS = 1 << 18
#: Members of a tile of a bucket, and their shingles, on average. A task compares two tiles.
TILE_MEMBERS, TILE_SHINGLES = 256, 1 << 19
#: Slack for rounding wherever a bound leaves a pair out.
EPSILON = 1e-6


def _folded_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = text_bytes(column)
    starts, ends, first = words.word_spans(data, offsets)
    return words.span_hashes(data, starts, ends, words.FOLDED), first


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task and slot, the texts with a word in it."""
    counts = np.zeros(SLOTS, np.int64)
    for batch in in_slices(batches, "text"):
        hashes, first = _folded_words(batch.column("text"))
        text = np.repeat(np.arange(len(first) - 1), np.diff(first)).astype(np.uint64)
        once = np.unique((text << np.uint64(20)) | (hashes >> np.uint64(44)))
        counts += np.bincount((once & np.uint64(SLOTS - 1)).astype(np.int64), minlength=SLOTS)
    used = np.flatnonzero(counts)
    if len(used):
        yield from pieces({"slot": used.astype(np.int32), "n": counts[used]})


def slot_weights(rows: DataFrame) -> np.ndarray:
    """1 + ln((1 + texts) / (1 + texts with the slot)) per slot, in whole 1/1024 so that sums are exact; at most
    ``SLOTS`` numbers reach the driver."""
    n = rows.count()
    counted = rows.mapInArrow(_frequencies, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(SLOTS)
    out[np.asarray(counted["slot"])] = np.asarray(counted["n"])
    return np.round(1024 * (1 + np.log((1 + n) / (1 + out)))).astype(np.int32)


def shingles(hashes: np.ndarray, first: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts given by word hashes: for each distinct shingle of each text its hash and weight, in the order of
    text and hash, and the index of each text's first one."""
    of_word = weights[(hashes >> np.uint64(44)).astype(np.int64)]
    n_words = np.diff(first)
    at, text = words.within(first, SHINGLE)
    key = words.joined(hashes, SHINGLE)[at] if len(at) else np.zeros(0, np.uint64)
    sums = np.concatenate([[0], np.cumsum(of_word, dtype=np.int64)])
    mean = (sums[at + SHINGLE] - sums[at]) / (1024.0 * SHINGLE)
    short = np.flatnonzero((n_words > 0) & (n_words < SHINGLE))
    if len(short):
        key = np.concatenate([key, [words.joined(hashes[first[i] : first[i + 1]], int(n_words[i]))[0] for i in short]])
        mean = np.concatenate([mean, [(sums[first[i + 1]] - sums[first[i]]) / (1024.0 * n_words[i]) for i in short]])
        text = np.concatenate([text, short])
    order = np.lexsort((key, text))
    key, text, mean = key[order], text[order], mean[order]
    new = np.r_[True, (key[1:] != key[:-1]) | (text[1:] != text[:-1])] if len(key) else np.zeros(0, bool)
    begins = np.flatnonzero(new)
    times = np.diff(np.r_[begins, len(key)])
    index = np.searchsorted(text[begins], np.arange(len(first)))
    return key[begins], (mean[begins] * times).astype(np.float32), index


class Sampler:
    """Improved consistent weighted sampling. For a shingle of weight S and each sample, with r, c ~ Gamma(2, 1) and
    b ~ Uniform(0, 1) drawn by the shingle's hash: t = floor(ln S / r + b), ln y = r (t - b), and the shingle with the
    least ln c - ln y - r is the sample, together with its t. Two texts agree in a sample with the probability of
    their weighted Jaccard similarity."""

    def __init__(self, samples: int = BANDS * ROWS):
        rng = np.random.Generator(np.random.Philox(7))
        self.samples = samples
        self.r = rng.gamma(2.0, 1.0, DRAWS).astype(np.float32)
        self.log_c = np.log(rng.gamma(2.0, 1.0, DRAWS)).astype(np.float32)
        self.b = rng.random(DRAWS).astype(np.float32)
        self.salts = words.mixed(np.arange(1, samples + 1, dtype=np.uint64) * words.BASE)

    def __call__(self, key: np.ndarray, weight: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Bands of each text (texts x BANDS); every text must have a shingle."""
        out = np.empty((len(first) - 1, self.samples), np.uint64)
        log_s = np.log(weight)
        begins, text = first[:-1], np.repeat(np.arange(len(first) - 1), np.diff(first))
        for i in range(self.samples):
            h = (key ^ self.salts[i]) * words.INVERSE
            draw = (h >> np.uint64(48)).astype(np.int32)
            r, b = self.r[draw], self.b[draw]
            t = np.floor(log_s / r + b)
            rank = self.log_c[draw] - r * (t - b + np.float32(1))
            least = np.minimum.reduceat(rank, begins)
            # Of equal ranks the smallest key: whatever the order or the other shingles are.
            won = np.flatnonzero(rank == least[text])
            new = np.r_[True, text[won][1:] != text[won][:-1]]
            won = won[new]
            out[:, i] = words.mixed(key[won] + t[won].astype(np.int64).astype(np.uint64) * words.BASE)
        bands = out.reshape(len(out), -1, ROWS)
        joined = bands[:, :, 0]
        for j in range(1, ROWS):
            joined = joined * words.BASE + bands[:, :, j]
        return words.mixed(joined + np.arange(joined.shape[1], dtype=np.uint64))


def _banded(weights: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler()
        for batch in in_slices(batches, "text", 1 << 20):
            hashes, first = _folded_words(batch.column("text"))
            key, weight, index = shingles(hashes, first, weights)
            full = np.flatnonzero(np.diff(index))
            if not len(full):
                continue
            bands = sampler(key, weight, np.r_[index[full], len(key)])
            # Two independent sums over the distinct shingles and their weights tell equal contents.
            own = words.mixed(key + weight.view(np.uint32).astype(np.uint64) * words.BASE)
            begins = index[full]
            content = pa.array(
                [
                    a.tobytes() + b.tobytes()
                    for a, b in zip(np.add.reduceat(own, begins), np.add.reduceat(words.mixed(own), begins), strict=True)
                ],
                pa.binary(),
            )
            lists = pa.ListArray.from_arrays(
                np.arange(0, bands.size + 1, bands.shape[1], dtype=np.int32), pa.array(bands.ravel().view(np.int64))
            )
            ids = pa.array(np.asarray(batch.column("id"))[full])
            total = np.add.reduceat(weight.astype(np.float64), begins)
            counts = np.diff(index)[full]
            yield from pieces({"id": ids, "content": content, "bands": lists, "total": total, "n_shingles": counts})

    return run


def _passed(filled: np.ndarray) -> Callable:
    """Rows whose id may be among those of a blocked Bloom filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block, mask = np.asarray(batch.column("block")), np.asarray(batch.column("mask"))
            yield batch.filter(pa.array((filled[block] & mask) == mask)).select(["id", "text"])

    return run


def texts_of(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, body) of the rows with an id of ``ids``, each id once. A Bloom filter of fixed size spares most other texts
    the exchange; those it lets through by mistake are removed by the join."""
    block = F.pmod(F.xxhash64("id"), F.lit(BLOOM_BLOCKS)).cast("int").alias("block")
    bits = F.xxhash64("id", F.lit(1))
    one = lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
    mask = one(0).bitwiseOR(one(1)).bitwiseOR(one(2)).alias("mask")
    rows = ids.select(block, mask).groupBy("block").agg(F.bit_or("mask").alias("bits")).toArrow()
    filled = np.zeros(BLOOM_BLOCKS, np.int64)
    filled[np.asarray(rows["block"])] = np.asarray(rows["bits"])
    near = texts.select("id", "text", block, mask).mapInArrow(_passed(filled), "id long, text string")
    return pack(near, "id", "text").join(ids, "id", "left_semi").dropDuplicates(["id"])


def _weighed(weights: np.ndarray) -> Callable:
    """Shingles of packed texts: key, id, weight."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, "body", 1 << 18):
            hashes, first = _folded_words(pa.array(unpacked(batch.column("body")), pa.large_binary()))
            key, weight, index = shingles(hashes, first, weights)
            yield from pieces({"key": key.view(np.int64), "id": np.repeat(np.asarray(batch.column("id")), np.diff(index)), "weight": weight})

    return run


def jaccard(key_a: np.ndarray, weight_a: np.ndarray, key_b: np.ndarray, weight_b: np.ndarray) -> float:
    """Sum of minima by sum of maxima; the keys are sorted and distinct."""
    at = np.searchsorted(key_b, key_a)
    at[at == len(key_b)] = 0
    same = key_b[at] == key_a if len(key_b) else np.zeros(len(key_a), bool)
    shared = float(np.minimum(weight_a[same], weight_b[at[same]]).sum(dtype=np.float64))
    total = float(weight_a.sum(dtype=np.float64) + weight_b.sum(dtype=np.float64)) - shared
    return shared / total if total else 0.0


def _similarities(weights: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, "body_b", 1 << 18):
            sides = []
            for column in ("body_a", "body_b"):
                hashes, first = _folded_words(pa.array(unpacked(batch.column(column)), pa.large_binary()))
                sides.append(shingles(hashes, first, weights))
            (key_a, weight_a, at_a), (key_b, weight_b, at_b) = sides
            found = [
                jaccard(key_a[a:b], weight_a[a:b], key_b[c:d], weight_b[c:d])
                for a, b, c, d in zip(at_a[:-1].tolist(), at_a[1:].tolist(), at_b[:-1].tolist(), at_b[1:].tolist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(found, pa.float64())], names=["a", "b", "similarity"])

    return run


def _tile_links(weights: np.ndarray, similarity: float, joining: bool = False) -> Callable:
    """The pairs of two tiles of a bucket that reach the similarity; only pairs that no bound leaves out are compared. With ``joining``
    only as many of them as join the components that any of them joins, fewer than members; pairs that these have joined are not compared."""

    def undecided(rows: pa.Table, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Which pairs can reach the similarity, lie in two components and share no earlier bucket. The similarity of a text to
        the bucket's lead may be unknown (NaN); comparisons with NaN leave nothing out."""
        sides = lambda name: (lambda x: (x[left][:, None], x[right][None, :]))(rows[name].to_numpy())
        (x, y), (p, q), (of_x, of_y) = sides("common"), sides("total"), sides("component")
        both = np.minimum(x, y)
        may = (of_x != of_y) & (both >= (similarity - EPSILON) * (p + q - both))
        (met_x, met_y), (far_x, far_y) = sides("met"), sides("far")
        # Two texts share at most the lesser of what they share with the lead, and the lesser of the rest that is not alone.
        both = np.minimum(met_x, met_y) + np.maximum(np.minimum(x - met_x, y - met_y), 0)
        may &= ~(both < (similarity - EPSILON) * (p + q - both))
        # The triangle inequality of the Jaccard distance.
        may &= ~(np.abs(far_x - far_y) > 1 - similarity + EPSILON)
        bands = rows["bands"].combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1)
        for i in range(rows["band"][0].as_py()):
            may &= bands[left, i][:, None] != bands[right, i][None, :]
        return may

    def run(rows: pa.Table) -> pa.Table:
        ids, tile = rows["id"].to_numpy(), rows["tile"].to_numpy()
        i, j = rows["i"][0].as_py(), rows["j"][0].as_py()
        left, right = np.flatnonzero(tile == i), np.flatnonzero(tile == j)
        # The component of each row; links of ``joining`` make components one.
        group = np.unique(rows["component"].to_numpy(), return_inverse=True)[1]
        out_a, out_b = [], []
        if len(left) and len(right):
            may = undecided(rows, left, right)
            if i == j:
                may &= ids[left][:, None] < ids[right][None, :]
            needed = np.union1d(left[may.any(1)], right[may.any(0)])
            keys, found, counts = [], [], []
            for batch in rows.select(["body"]).take(pa.array(needed)).to_batches():
                for part in in_slices([batch], "body", 1 << 18):
                    hashes, first = _folded_words(pa.array(unpacked(part.column("body")), pa.large_binary()))
                    key, weight, index = shingles(hashes, first, weights)
                    keys.append(key), found.append(weight), counts.append(np.diff(index))
            if len(needed):
                key, weight = np.concatenate(keys), np.concatenate(found)
                ends = np.cumsum(np.concatenate(counts))
                starts = np.r_[0, ends[:-1]]
                total = np.add.reduceat(weight.astype(np.float64), starts)
                numbers = np.unique(key, return_inverse=True)[1]
                place = np.zeros(rows.num_rows, np.int64)
                place[needed] = np.arange(len(needed))
                mine = np.zeros(int(numbers.max()) + 1, np.float32)
                for row in np.flatnonzero(may.any(1)):
                    apart = right[may[row] & (group[right] != group[left[row]])] if joining else right[may[row]]
                    if not len(apart):
                        continue
                    a, others = place[left[row]], place[apart]
                    own = slice(starts[a], ends[a])
                    mine[numbers[own]] = weight[own]
                    lengths = ends[others] - starts[others]
                    at = ranges(starts[others], lengths)
                    least = np.minimum(mine[numbers[at]], weight[at]).astype(np.float64)
                    shared = np.add.reduceat(least, np.r_[0, np.cumsum(lengths)[:-1]])
                    mine[numbers[own]] = 0
                    close = shared / (total[a] + total[others] - shared)
                    for at_b in np.flatnonzero(close >= similarity - EPSILON).tolist():
                        b, value = others[at_b], close[at_b]
                        if joining and group[apart[at_b]] == group[left[row]]:
                            continue
                        # Sums in another order differ in their last bits; at the threshold the usual one decides.
                        if value < similarity + EPSILON:
                            value = jaccard(key[own], weight[own], key[starts[b] : ends[b]], weight[starts[b] : ends[b]])
                        if value >= similarity:
                            out_a.append(ids[needed[a]])
                            out_b.append(ids[needed[b]])
                            if joining:
                                group[group == group[apart[at_b]]] = group[left[row]]
        return pa.table({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})

    return run


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row per input row: ``id_col, class_id, component_id, class_size, kept``.

    Texts with the same weighted shingles form a class, named after its smallest id; classes linked by a weighted
    Jaccard similarity of at least ``similarity`` form a component, named likewise; ``kept`` is one row of each
    component, that of the component's id.

    Candidates are classes that share a band. What a class has in common with any other candidate bounds its
    similarities from above (a shingle found nowhere else is never shared), which leaves out most members of a group whose edits differ. Each
    class is compared with a lead of its bucket, one that shares the most buckets (a star, as many pairs as rows), and
    components are formed. Then only pairs are left whose classes share a bucket but no component. A bucket that has such pairs is dealt
    into tiles of bounded size, and a task compares two tiles: the bound and the triangle inequality of the Jaccard distance leave out
    what cannot reach the similarity, the others are compared in full until a link joins their components, and only such links leave the
    task, fewer than it has members. So no link between components is lost, no pair is ever a row, and members of one component are not
    compared again.

    Defined cases: null texts and texts without words are classes of their own and are kept; rows with a null id are
    kept and never compared; rows that repeat an id with the same text are one node and are kept or dropped together; rows that repeat
    an id with different texts are compared each by its own text, and of such rows in one component that of the smallest 64-bit hash is
    kept; an empty table gives an empty result; other columns are ignored.
    """
    told, _ = _told(docs, id_col, text_col, similarity)
    return told.select(F.col("id").alias(id_col), "class_id", "component_id", "class_size", "kept")


def _told(docs: DataFrame, id_col: str, text_col: str, similarity: float) -> tuple[DataFrame, bool]:
    """What ``near_groups`` tells, and whether some id has several texts; then ``own`` is the hash of each row's text.

    Where an id has several texts, all but that of the smallest hash get a node number below zero from the hash of id and text, and the
    groups are named by ids again afterwards.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    hashed = rows.where("id IS NOT NULL").select("id", F.xxhash64("text").alias("own"))
    several = store(hashed.groupBy("id").agg(F.min("own").alias("least"), F.max("own").alias("most")).where("least != most").select("id", "least"))
    if not several.limit(1).count():
        return _groups(rows, similarity), False
    own = F.xxhash64("text")
    number = F.when(F.col("least").isNull() | (own == F.col("least")), F.col("id")).otherwise(F.xxhash64("id", "text").bitwiseOR(F.lit(-(2**63))))
    numbered = store(rows.join(several, "id", "left").select("id", number.alias("node"), own.alias("own"), "text"))
    found = store(_groups(numbered.select(F.col("node").alias("id"), "text"), similarity).withColumnRenamed("id", "node"))
    found = found.join(numbered.where("id IS NOT NULL").select("node", "id", "own").distinct(), "node", "left")
    order = F.struct("id", "own", "node")
    classes = found.groupBy("class_id").agg(F.min("id").alias("class"))
    components = found.groupBy("component_id").agg(F.min(order).alias("least"))
    found = found.join(classes, "class_id", "left").join(components, "component_id", "left")
    kept = F.coalesce(F.col("node") == F.col("least.node"), F.lit(True))
    return found.select("id", "own", F.col("class").alias("class_id"), F.col("least.id").alias("component_id"), "class_size", kept.alias("kept")), True


def _groups(rows: DataFrame, similarity: float) -> DataFrame:
    """``near_groups`` of rows ``id, text`` whose ids have one text each."""
    texts = rows.where("id IS NOT NULL AND text IS NOT NULL")
    weights = slot_weights(texts.select("text"))
    signed = store(texts.mapInArrow(_banded(weights), "id long, content binary, bands array<long>, total double, n_shingles long"))
    classes = store(signed.groupBy("content").agg(F.min("id").alias("class"), F.count(F.lit(1)).alias("class_size")))
    members = store(signed.select("id", "content").join(classes, "content").select("id", "class", "class_size"))
    heads = signed.join(classes.where("class IS NOT NULL"), ["content"]).where("id = class").select("id", "bands", "total", "n_shingles").dropDuplicates(["id"])
    buckets = heads.select("id", F.posexplode("bands").alias("band", "bucket"))
    sizes = buckets.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = store(buckets.join(sizes, ["band", "bucket"]))
    # Who shares the most and largest buckets is near the middle of its group, so it makes a good lead.
    central = shared.groupBy("id").agg(F.sum("n").alias("central"))
    # Only texts that share a bucket travel again, compressed.
    bodies = store(texts_of(texts, central.select("id")))
    # The weight of shingles that no other of these texts has takes no part in any similarity.
    terms = bodies.mapInArrow(_weighed(weights), "key long, id long, weight float").repartition("key")
    alone = terms.groupBy("key").agg(F.min("id").alias("id"), F.max("id").alias("most"), F.min("weight").alias("weight")).where("id = most")
    alone = alone.groupBy("id").agg(F.sum(F.col("weight").cast("double")).alias("alone"))
    measured = central.join(heads.select("id", "total"), "id").join(alone, "id", "left")
    measured = measured.select("id", "central", "total", (F.col("total") - F.coalesce("alone", F.lit(0.0))).alias("common"))
    measured = measured.where(F.col("common") >= (similarity - EPSILON) * F.col("total"))
    shared = store(shared.drop("n").join(measured, "id"))

    def compared(pairs: DataFrame) -> DataFrame:
        left, right = (bodies.select(F.col("id").alias(c), F.col("body").alias(f"body_{c}")) for c in "ab")
        return store(pairs.join(right, "b").join(left, "a").mapInArrow(_similarities(weights), "a long, b long, similarity double"))

    def reachable(a: str, b: str) -> Column:
        """Whether what the texts have in common with any others can make them similar enough."""
        both = F.least(f"{a}common", f"{b}common")
        return both >= (similarity - EPSILON) * (F.col(f"{a}total") + F.col(f"{b}total") - both)

    lead = F.max_by(F.struct("id", "common", "total"), F.struct("central", -F.col("id"))).alias("lead")
    led = shared.join(shared.groupBy("band", "bucket").agg(lead), ["band", "bucket"]).drop("central")
    led = led.select("band", "bucket", "id", "common", "total", *(F.col(f"lead.{c}").alias(f"lead_{c}") for c in ("id", "common", "total")))
    star = led.where("id != lead_id").where(reachable("", "lead_")).select(F.col("lead_id").alias("a"), F.col("id").alias("b")).distinct()
    first = compared(star)
    linked = first.where(F.col("similarity") >= similarity).select("a", "b")
    found = store(components(linked))
    # What is left are pairs of one bucket in two components.
    placed = led.join(found.withColumnRenamed("node", "id"), "id", "left")
    placed = placed.join(first.select(F.col("a").alias("lead_id"), F.col("b").alias("id"), (1 - F.col("similarity")).alias("far")), ["lead_id", "id"], "left")
    far = F.when(F.col("id") == F.col("lead_id"), 0.0).otherwise(F.col("far"))
    # Jaccard similarity s of totals p and q means that s / (1 + s) * (p + q) is shared.
    met = (1 - far) / (2 - far) * (F.col("total") + F.col("lead_total"))
    placed = placed.select("band", "bucket", "id", "common", "total", F.coalesce("component", "id").alias("component"), far.alias("far"), met.alias("met"))
    placed = placed.join(heads.select("id", "bands", "n_shingles"), "id")
    # The members of a bucket's largest component are not compared with each other, so they have tiles of their own.
    parts = placed.groupBy("band", "bucket", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("size"))
    parts = parts.groupBy("band", "bucket").agg(
        F.max(F.struct("n", -F.col("component"), "component", "size")).alias("most"),
        F.sum("n").alias("n"), F.sum("size").alias("size"), F.count(F.lit(1)).alias("n_parts"),
    )
    tiles = lambda n, size: F.ceil(F.greatest(n / TILE_MEMBERS, size / TILE_SHINGLES)).cast("int")
    parts = parts.where("n_parts > 1").select(
        "band", "bucket", F.col("most.component").alias("largest"), tiles(F.col("most.n"), F.col("most.size")).alias("n_largest"),
        tiles(F.col("n") - F.col("most.n"), F.col("size") - F.col("most.size")).alias("n_rest"),
    )
    placed = placed.join(parts, ["band", "bucket"])
    dealt = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    tile = F.when(F.col("component") == F.col("largest"), F.col("n_rest") + dealt("n_largest")).otherwise(dealt("n_rest"))
    placed = placed.withColumn("tile", tile).drop("n_shingles", "largest").join(bodies, "id")
    # A tile of the rest meets itself and every later one, so no task holds more than two tiles and no pair is a row.
    as_left = F.transform(F.sequence("tile", F.col("n_rest") + F.col("n_largest") - 1), lambda j: F.struct(F.col("tile").alias("i"), j.alias("j")))
    as_right = F.transform(F.sequence(F.lit(0), F.least("tile", "n_rest") - 1), lambda i: F.struct(i.alias("i"), F.col("tile").alias("j")))
    none = F.array().cast("array<struct<i:int,j:int>>")
    meets = F.concat(F.when(F.col("tile") < F.col("n_rest"), as_left).otherwise(none), F.when(F.col("tile") > 0, as_right).otherwise(none))
    met_by = placed.select("band", "bucket", "tile", "id", "component", "common", "total", "far", "met", "bands", "body", F.inline(meets))
    second = store(met_by.groupBy("band", "bucket", "i", "j").applyInArrow(_tile_links(weights, similarity, True), "a long, b long"))
    if second.limit(1).count():
        found = store(components(linked.unionByName(second)))
    joined = members.join(found.withColumnRenamed("node", "class"), "class", "left").select(
        F.col("id").alias("__id"), "class", "class_size", F.coalesce("component", "class").alias("component")
    )
    placed = rows.select("id").join(joined.dropDuplicates(["__id"]), F.col("id") == F.col("__id"), "left")
    return placed.select(
        "id",
        F.coalesce("class", "id").alias("class_id"),
        F.coalesce("component", "id").alias("component_id"),
        F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near copies, all columns as they were. Defined cases as in ``near_groups``."""
    told, by_text = _told(docs, id_col, text_col, SIMILARITY)
    id_name, own_name = unused(docs, "__id", "__own")
    gone = told.where("NOT kept").select(F.col("id").alias(id_name), *([F.col("own").alias(own_name)] if by_text else []))
    same = F.col(id_col).cast("long") == F.col(id_name)
    if by_text:
        same &= F.xxhash64(text_col) == F.col(own_name)
    return docs.join(store(gone.distinct() if by_text else gone), same, "left_anti")
