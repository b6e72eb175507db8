"""Single decision trees of many candidates and folds, each grown whole by one task.

Fitted one by one, MLlib counts the rows, finds the splits and turns the rows into bins anew for each candidate, and every level is a job in
which each partition sums all bins of all nodes, small as they are. Here MLlib finds the splits once per fold and class weight, each row
becomes one byte per column (its bin and its class), and a task that has these bytes of all rows grows the trees of some candidates on the
training part of one fold and counts their hits on the rest.

The trees are MLlib's: the same splits and draws of columns, the same arithmetic of impurities, the first of equally good splits. Sums of
class weights are those of rows in one partition; where MLlib adds up several partitions, its last bits differ.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle, inheritable_thread_target
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Executors need not have this package: the task functions travel with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Most bytes (rows x columns) that a task is to hold; beyond, trees are left to MLlib, whose rows stay spread.
TASK_BYTES = 256_000_000
BINS = 32  # MLlib's maxBins, which no search of single trees sets; its sample of the rows can give a column some more
MOST_BINS = 128  # a byte holds 2 * bin + class
#: Tasks per core: the more, the evener the load, and the more copies of the rows are shuffled.
TASKS_PER_CORE = 3
#: A node with as many rows keeps its counts: those of its larger child are what the smaller child leaves of them.
KEPT_ROWS = 512
#: Nodes and bytes (rows x columns) that are worked on at once.
NODES, CHUNK = 64, 2**18
MLLIB_MEMORY = 256 << 20  # maxMemoryInMB: decides in what order MLlib draws columns for the nodes
EPSILON = 2.0**-52


@dataclass(frozen=True)
class Tree:
    """What MLlib's parameters say of one tree; ``picked`` columns are drawn for each node, unless they are all."""

    entropy: bool
    depth: int
    least: int
    picked: int
    forest: bool


@dataclass(frozen=True)
class Part:
    """The work of a task: trees by the number of their candidate, the fold left out, class weights, and the splits of each column."""

    fold: int
    trees: tuple[tuple[int, Tree], ...]
    weights: tuple[float, float]
    thresholds: tuple[np.ndarray, ...]


def tree_of(estimator: type, params: dict, columns: int) -> Tree | None:
    """The single tree that MLlib would grow; None for anything else, or with a parameter that is not known here."""
    if estimator not in (DecisionTreeClassifier, RandomForestClassifier):
        return None
    left = dict(params)
    entropy, depth, least = left.pop("impurity") == "entropy", left.pop("maxDepth"), left.pop("minInstancesPerNode")
    if estimator is DecisionTreeClassifier and not left:
        return Tree(entropy, depth, least, columns, False)
    subset = left.pop("featureSubsetStrategy", None)
    if left != {"numTrees": 1, "bootstrap": False} or subset not in ("sqrt", "log2"):
        return None
    picked = math.ceil(math.sqrt(columns)) if subset == "sqrt" else max(1, math.ceil(math.log(columns) / math.log(2)))
    return Tree(entropy, depth, least, picked, True)


def thresholds(vectors: DataFrame, label: str, weight: str, seed: int) -> tuple[np.ndarray, ...]:
    """MLlib's candidate splits of each column of assembled ``features``, from its own sample of these rows."""
    jvm = vectors.sparkSession.sparkContext._jvm
    impl = jvm.org.apache.spark.ml.tree.impl
    estimator = DecisionTreeClassifier(featuresCol="features", labelCol=label, weightCol=weight, maxBins=BINS)
    estimator._transfer_params_to_java()
    utils = getattr(jvm.org.apache.spark.ml.util, "DatasetUtils$").__getattr__("MODULE$")
    rows = utils.extractInstances(estimator._java_obj, vectors._jdf, jvm.scala.Some(2))
    strategy = jvm.org.apache.spark.mllib.tree.configuration.Strategy.defaultStrategy("Classification")
    strategy.setMaxBins(BINS)
    found = getattr(impl, "RandomForest$").__getattr__("MODULE$").findSplits(rows, impl.DecisionTreeMetadata.buildMetadata(rows, strategy, 1, "all"), seed)
    return tuple(np.array([split.threshold() for split in column], dtype=float) for column in found)


# --- draws of columns --------------------------------------------------------------------------------


class _Longs:
    """``java.util.Random.nextLong``."""

    def __init__(self, seed: int):
        self.state = (seed ^ 0x5DEECE66D) & (1 << 48) - 1

    def _next(self) -> int:
        self.state = (self.state * 0x5DEECE66D + 0xB) & (1 << 48) - 1
        return self.state >> 16

    def draw(self) -> int:
        high, low = self._next(), self._next()
        return ((high << 32) + low - (low >> 31 << 32)) & (1 << 64) - 1


def _murmur(words: Sequence[np.ndarray], seed: np.ndarray) -> np.ndarray:
    """Scala's ``MurmurHash3.bytesHash`` of 32-bit words."""
    rotated = lambda x, by: x << np.uint32(by) | x >> np.uint32(32 - by)
    h = seed
    for k in words:
        k = rotated(k * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593)
        h = rotated(h ^ k, 13) * np.uint32(5) + np.uint32(0xE6546B64)
    h = h ^ np.uint32(4 * len(words))
    h = (h ^ h >> np.uint32(16)) * np.uint32(0x85EBCA6B)
    h = (h ^ h >> np.uint32(13)) * np.uint32(0xC2B2AE35)
    return h ^ h >> np.uint32(16)


def _picked(seeds: np.ndarray, columns: int, k: int) -> np.ndarray:
    """For each seed the ``k`` columns of MLlib's reservoir sample, in its order."""
    words = [(seeds >> np.uint64(32)).astype(np.uint32).byteswap(), seeds.astype(np.uint32).byteswap()]
    low = _murmur(words, np.full(len(seeds), 0x3C074A61, np.uint32))
    state = _murmur(words, low).astype(np.uint64) << np.uint64(32) | low.astype(np.uint64)
    out = np.tile(np.arange(k), (len(seeds), 1))
    for item in range(k, columns):
        bits = []
        for n in (26, 27):
            state = state ^ state << np.uint64(21)
            state = state ^ state >> np.uint64(35)
            state = state ^ state << np.uint64(4)
            bits.append(state & np.uint64((1 << n) - 1))
        at = ((bits[0] << np.uint64(27)) + bits[1]).astype(float) * 2.0**-53 * (item + 1)
        at = at.astype(np.int64)
        taken = np.flatnonzero(at < k)
        out[taken, at[taken]] = item
    return out


# --- growing -----------------------------------------------------------------------------------------


def _spans(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The positions of all spans one after the other, and the span that each belongs to."""
    owner = np.repeat(np.arange(len(starts)), lengths)
    return np.arange(len(owner)) + (starts - (np.cumsum(lengths) - lengths))[owner], owner


def _counts(codes: np.ndarray, rows: np.ndarray, owner: np.ndarray, k: int, columns: np.ndarray | None, bins: int) -> np.ndarray:
    """(node, column, bin, class) counts of rows, ordered by their node ``owner``; ``columns`` are those of each node, None for all."""
    width = codes.shape[1]
    s = width if columns is None else columns.shape[1]
    one = s * 2 * bins
    base, out = np.arange(s) * (2 * bins), np.zeros(k * one, np.int64)
    step = max(1, CHUNK // s)
    for a in range(0, len(rows), step):
        some, own = rows[a : a + step], owner[a : a + step]
        first, last = own[0], own[-1] + 1
        keys = codes[some].astype(np.int64) if columns is None else codes.ravel()[(some * width)[:, None] + columns[own]].astype(np.int64)
        keys += base
        keys += ((own - first) * one)[:, None]
        out[first * one : last * one] += np.bincount(keys.ravel(), minlength=(last - first) * one)
    return out.reshape(k, s, bins, 2)


def _impurity(zero: np.ndarray, one: np.ndarray, total: np.ndarray, entropy: bool) -> np.ndarray:
    f0, f1 = zero / total, one / total
    if not entropy:
        return 1.0 - f0 * f0 - f1 * f1
    terms = [np.where(f > 0, f * (np.log(np.where(f > 0, f, 1.0)) / math.log(2)), 0.0) for f in (f0, f1)]
    return 0.0 - terms[0] - terms[1]


class _Grower:
    """Grows trees on the rows ``train`` of ``codes``."""

    def __init__(self, codes: np.ndarray, train: np.ndarray, weights: tuple[float, float], splits: Sequence[int], seed: int):
        self.codes, self.train, self.seed = codes, train, seed
        self.splits = np.array(splits)
        self.bins = int(self.splits.max()) + 1
        # The sums of as many equal weights, added up one by one.
        self.sums = [None if w == 1 else np.concatenate([[0.0], np.cumsum(np.full(len(train), w))]) for w in weights]
        self.root = _counts(codes, train, np.zeros(len(train), np.int64), 1, None, self.bins)

    def _best(self, counts: np.ndarray, columns: np.ndarray | None, impurity: np.ndarray, tree: Tree) -> dict[str, np.ndarray]:
        """The best split of each node; the root's ``impurity`` is NaN, as its parent has not told it."""
        zero, one = (np.cumsum(counts[..., c].astype(float) if self.sums[c] is None else self.sums[c][counts[..., c]], axis=2) for c in (0, 1))
        raw = np.cumsum(counts.sum(axis=3), axis=2)
        l0, l1, rows = zero[:, :, :-1], one[:, :, :-1], raw[:, :, :-1]
        r0, r1 = zero[:, :, -1:] - l0, one[:, :, -1:] - l1
        with np.errstate(invalid="ignore", divide="ignore"):
            left, right = l0 + l1, r0 + r1
            total = left + right
            own = np.where(np.isnan(impurity), _impurity(p0 := l0[:, 0, 0] + r0[:, 0, 0], p1 := l1[:, 0, 0] + r1[:, 0, 0], p0 + p1, tree.entropy), impurity)
            li, ri = _impurity(l0, l1, left, tree.entropy), _impurity(r0, r1, right, tree.entropy)
            gain = own[:, None, None] - left / total * li - right / total * ri
        splits = self.splits[np.arange(len(self.splits)) if columns is None else columns]
        known = np.arange(self.bins - 1) < splits[..., None]
        gain = np.where(known & (rows >= tree.least) & (raw[:, :, -1:] - rows >= tree.least), gain, -np.inf)
        k = np.arange(len(gain))
        column, cut = np.divmod(gain.reshape(len(gain), -1).argmax(axis=1), self.bins - 1)
        pick = lambda x: x[k, column, cut]
        return {
            "gain": pick(gain),
            "column": column if columns is None else columns[k, column],
            "cut": cut,
            "rows": pick(rows),
            "impurity": np.stack([pick(li), pick(ri)], axis=1),
            "says": np.stack([self._says(pick(a), pick(b), tree) for a, b in ((l0, l1), (r0, r1))], axis=1),
            "own": self._says(p0, p1, tree),
        }

    @staticmethod
    def _says(zero: np.ndarray, one: np.ndarray, tree: Tree) -> np.ndarray:
        if not tree.forest:
            return one > zero
        with np.errstate(invalid="ignore", divide="ignore"):
            total = zero + one
            return one / total > zero / total

    def _draws(self, todo: np.ndarray, longs: _Longs, tree: Tree) -> np.ndarray:
        """Columns of the next nodes, as many as MLlib handles at once; it draws for one more to see that it has no room."""
        states, seeds = [], []
        for _ in todo:
            seeds.append(longs.draw())
            states.append(longs.state)
        columns = _picked(np.array(seeds, np.uint64), len(self.splits), tree.picked)
        used = np.cumsum((self.splits[columns] + 1).sum(axis=1) * 16)
        n = max(1, int(np.searchsorted(used, MLLIB_MEMORY, side="right")))
        longs.state = states[min(n, len(states) - 1)]
        return columns[:n]

    def _found(self, nodes: np.ndarray, columns: np.ndarray | None, start: np.ndarray, stop: np.ndarray, impurity: np.ndarray, tree: Tree, kept: dict) -> dict:
        """The best splits of nodes, a few of them at a time. ``kept`` has the counts of nodes that were split, by their larger child."""
        parts, lengths = [], stop - start
        direct = np.ones(len(nodes), bool)
        if columns is None:
            direct = np.array([n not in kept for n in nodes], bool)
        done = np.zeros(len(nodes), np.int64)
        place = 0
        many = np.flatnonzero(direct)
        for a in range(0, len(many), NODES):
            some = many[a : a + NODES]
            own = None if columns is None else columns[some]
            if nodes[some[0]] == 0:
                counts = self.root if own is None else self.root[:, own[0]]
            else:
                at, owner = _spans(start[some], lengths[some])
                counts = _counts(self.codes, self.order[at], owner, len(some), own, self.bins)
            if own is None:
                for i in np.flatnonzero(lengths[some] >= KEPT_ROWS):
                    self.counts[nodes[some[i]]] = counts[i].astype(np.int32)
            parts.append(self._best(counts, own, impurity[some], tree))
            done[some] = np.arange(place, place + len(some))
            place += len(some)
        for i in np.flatnonzero(~direct):
            whole, a, b, sibling = kept.pop(nodes[i])
            small = self.counts.get(sibling)
            if small is None:
                small = _counts(self.codes, self.order[a:b], np.zeros(b - a, np.int64), 1, None, self.bins)[0]
            counts = whole - small
            self.counts[nodes[i]] = counts
            parts.append(self._best(counts[None].astype(np.int64), None, impurity[i : i + 1], tree))
            done[i] = place
            place += 1
        return {name: np.concatenate([p[name] for p in parts])[done] for name in parts[0]}

    def grow(self, tree: Tree) -> tuple[np.ndarray, ...]:
        """Of each node the column (-1: a leaf), the last bin that goes left, the left child (the right one follows), and the class."""
        width = len(self.splits)
        drawn = tree.picked != width
        longs = _Longs(self.seed)
        self.order, self.counts, kept = self.train.copy(), {}, {}
        column, cut, left, says = [np.array([-1])], [np.array([0])], [np.array([0])], [np.array([False])]
        n = 1
        # The nodes to split, the next one last: number, level, span of rows, impurity.
        ids, level, start, stop, impurity = np.array([0]), np.array([0]), np.array([0]), np.array([len(self.train)]), np.array([np.nan])
        pieces: list[tuple[np.ndarray, ...]] = []
        while len(ids):
            columns = self._draws(ids, longs, tree) if drawn else None
            take = len(ids) - (len(columns) if drawn else len(ids))
            now = [x[take:][::-1] for x in (ids, level, start, stop, impurity)]
            ids, level, start, stop, impurity = (x[:take] for x in (ids, level, start, stop, impurity))
            self.counts = {}
            best = self._found(now[0], columns, now[2], now[3], now[4], tree, kept)
            if n == 1:
                says[0] = best["own"][:1]
            split = np.flatnonzero((best["gain"] > 0) & (now[1] < tree.depth))
            if not len(split):
                continue
            node, depth, a, b, _ = (x[split] for x in now)
            best = {name: x[split] for name, x in best.items()}
            middle = a + best["rows"]
            # Rows of a node that go left come first.
            at, owner = _spans(a, b - a)
            rows = self.order[at]
            goes = self.codes.ravel()[rows * width + best["column"][owner]] >> 1 <= best["cut"][owner]
            rank = np.cumsum(goes) - goes
            rank -= rank[np.cumsum(b - a) - (b - a)][owner]
            inside = at - a[owner]
            self.order[np.where(goes, a[owner] + rank, middle[owner] + inside - rank)] = rows
            children = n + 2 * np.arange(len(split))
            n += 2 * len(split)
            pieces.append((node, best["column"], best["cut"], children))
            column.append(np.full(2 * len(split), -1))
            says.append(best["says"].ravel())
            live = (depth + 1 < tree.depth)[:, None] & (np.abs(best["impurity"]) >= EPSILON)
            spans = np.stack([np.stack([a, middle], 1), np.stack([middle, b], 1)], 1)  # (split, side, ends)
            if not drawn:
                larger = (b - middle > middle - a).astype(int)
                for i in np.flatnonzero(((b - a) >= KEPT_ROWS) & live[np.arange(len(split)), larger]):
                    if (whole := self.counts.get(node[i])) is not None:
                        side = larger[i]
                        kept[children[i] + side] = (whole, *spans[i, 1 - side], children[i] + 1 - side)
            live = live.ravel()
            more = ((children[:, None] + [0, 1]).ravel(), np.repeat(depth + 1, 2), spans[:, :, 0].ravel(), spans[:, :, 1].ravel(), best["impurity"].ravel())
            ids, level, start, stop, impurity = (np.concatenate([x, y[live]]) for x, y in zip((ids, level, start, stop, impurity), more, strict=True))
        column, cut, left = np.full(n, -1), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for node, c, s, children in pieces:
            column[node], cut[node], left[node] = c, s, children
        return column, cut, left, np.concatenate(says)


def _predicted(codes: np.ndarray, rows: np.ndarray, grown: tuple[np.ndarray, ...]) -> np.ndarray:
    column, cut, left, says = grown
    at, open_ = np.zeros(len(rows), np.int64), np.arange(len(rows))
    while len(open_ := open_[column[at[open_]] >= 0]):
        node = at[open_]
        right = codes.ravel()[rows[open_] * codes.shape[1] + column[node]] >> 1 > cut[node]
        at[open_] = left[node] + right
    return says[at]


# --- tasks -------------------------------------------------------------------------------------------


def _coded(parts: Sequence[Part], columns: int) -> Callable:
    """One row per part and batch: the batch's rows as bytes, and their folds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(columns)]
            if any(np.isnan(c).any() for c in x):
                raise ValueError("null or NaN in a feature")
            y = batch.column("label").to_numpy(zero_copy_only=False).astype(np.uint8)
            folds = batch.column("fold").to_numpy(zero_copy_only=False).astype(np.int32).tobytes()
            known: dict[int, bytes] = {}
            for i, part in enumerate(parts):
                blob = known.get(id(part.thresholds))
                if blob is None:
                    codes = np.empty((len(y), columns), np.uint8)
                    for c in range(columns):
                        codes[:, c] = 2 * np.searchsorted(part.thresholds[c], x[c]) + y
                    blob = known[id(part.thresholds)] = codes.tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([blob]), pa.array([folds])], names=["part", "codes", "folds"])

    return run


def _grown(parts: Sequence[Part], n: int, columns: int, seed: int) -> Callable:
    """(candidate, fold, hits, n) of each tree of the part whose ``n`` rows a task has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, fold, filled, part = np.empty((n, columns), np.uint8), np.empty(n, np.int32), 0, None
        for batch in batches:
            for i, some, own in zip(*(batch.column(c) for c in range(3)), strict=True):
                part, own = parts[i.as_py()], np.frombuffer(own.as_buffer(), np.int32)
                codes[filled : filled + len(own)] = np.frombuffer(some.as_buffer(), np.uint8).reshape(-1, columns)
                fold[filled : filled + len(own)] = own
                filled += len(own)
        if part is None:
            return
        if filled != n:
            raise ValueError(f"{filled} of {n} rows")
        train, held = (np.flatnonzero(x) for x in (fold != part.fold, fold == part.fold))
        truth = codes[held, 0] & 1
        grower = _Grower(codes, train, part.weights, [len(t) for t in part.thresholds], seed)
        for candidate, tree in part.trees:
            hits = int((_predicted(codes, held, grower.grow(tree)) == truth).sum())
            yield pa.RecordBatch.from_pydict({"candidate": [candidate], "fold": [part.fold], "hits": [hits], "n": [len(held)]})

    return run


def _shared(trees: Sequence[tuple[int, Tree]], columns: int, n: int) -> list[tuple[tuple[int, Tree], ...]]:
    """At most ``n`` parts of trees that cost about the same."""
    parts: list[list] = [[] for _ in range(min(n, len(trees)))]
    cost = [0] * len(parts)
    for one in sorted(trees, key=lambda pair: (-pair[1].picked * pair[1].depth, pair[0])):
        i = cost.index(min(cost))
        parts[i].append(one)
        cost[i] += one[1].picked * one[1].depth + columns
    return [tuple(p) for p in parts]


def accuracies(
    stored: DataFrame,
    vectors: DataFrame,
    features: Sequence[str],
    label: str,
    folds: int,
    trees: Sequence[Tree],
    weights: Sequence[Sequence[tuple[float, float]]],
    n: int,
    seed: int,
) -> dict[tuple[int, int], float] | None:
    """By tree and fold, the share of the fold's rows whose class a tree grown on the other folds tells; None where a column has so many
    splits that a byte does not hold its bins.

    ``vectors`` are the ``n`` rows of ``stored`` with their ``features`` assembled; ``weights`` are those of classes 0 and 1, by tree and fold.
    """
    context = stored.sparkSession.sparkContext
    jobs: dict[tuple[int, tuple[float, float]], list[tuple[int, Tree]]] = {}
    for i, tree in enumerate(trees):
        for fold in range(folds):
            jobs.setdefault((fold, weights[i][fold]), []).append((i, tree))
    share = max(1, math.ceil(TASKS_PER_CORE * context.defaultParallelism / len(jobs)))

    def of(job: tuple[int, tuple[float, float]]) -> list[Part]:
        fold, pair = job
        weight = F.when(F.col(label) == 1, F.lit(pair[1])).otherwise(F.lit(pair[0]))
        found = thresholds(vectors.where(F.col("fold") != fold).withColumn("weight", weight), label, "weight", seed)
        return [Part(fold, some, pair, found) for some in _shared(jobs[job], len(features), share)]

    with ThreadPool(len(jobs)) as pool:
        parts = [part for some in pool.map(inheritable_thread_target(stored.sparkSession)(of), jobs, chunksize=1) for part in some]
    if any(len(t) >= MOST_BINS for part in parts for t in part.thresholds):
        return None
    data = stored.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)], F.col(label).cast("int").alias("label"), F.col("fold").cast("int").alias("fold"))
    coded = data.mapInArrow(_coded(parts, len(features)), "part int, codes binary, folds binary")
    dealt = coded.repartitionById(len(parts), "part")
    out = dealt.mapInArrow(_grown(parts, n, len(features), seed), "candidate long, fold long, hits long, n long").collect()
    return {(r.candidate, r.fold): r.hits / r.n if r.n else math.nan for r in out}
