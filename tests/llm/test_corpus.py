"""The corpus operators on planted cases and against brute force."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from churn_engine.llm import chunked_bpe, exact_dedup, license_scan, near_dedup, packing, quality, substring_dedup, url_filter, vector_dedup, warc, words
from churn_engine.llm.common import components, shared_folder, text_bytes

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, id int"


def documents(spark, rows: list[tuple[int | None, str | None]]):
    """Documents with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, None, "s", None if t is None else len(t), "x", 1) for i, t in rows], SCHEMA)


def prose(seed: int, n: int) -> list[str]:
    rng = np.random.default_rng(seed)
    return [f"w{x}" for x in rng.integers(0, 3000, n)]


ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "a"), (None, "null id"), (5, "Same Text"), (6, "same text"), (6, "same text"), (7, "x " * 40000)]


# words


@given(st.lists(st.text(max_size=30), max_size=6))
@settings(max_examples=60, deadline=None)
def test_words_and_hashes(texts):
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    starts, ends, first = words.word_spans(data, offsets)
    found = [bytes(data[a:b]) for a, b in zip(starts, ends, strict=True)]
    assert [found[a:b] for a, b in zip(first[:-1], first[1:], strict=True)] == [t.encode().split() for t in texts]
    hashes = words.span_hashes(data, starts, ends)
    assert len(set(zip(found, hashes.tolist(), strict=True))) == len(set(found))


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7), (101, 100)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


# 10: exact dedup


@pytest.mark.parametrize("digest", [exact_dedup.sha256_of, lambda body: F.substring(F.sha2(body.cast("binary"), 256), 1, 1)])
def test_exact_groups_also_when_digests_collide(spark, digest):
    rows = ODD[:4] + [(10 + i, f"Text {i % 7}") for i in range(60)]
    found = {r.doc_id: r for r in exact_dedup.exact_groups(documents(spark, rows), digest=digest).collect()}
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").lower()].append(i)
    for i, t in rows:
        own = groups[(t or "").lower()]
        assert (found[i].keep_id, found[i].group_size, found[i].kept) == (max(own), len(own), i == max(own))
        assert found[i].text_sha256 == hashlib.sha256((t or "").lower().encode()).hexdigest()


def test_exact_odd_rows(spark):
    assert exact_dedup.exact_groups(documents(spark, [])).count() == 0
    assert exact_dedup.exact_groups(documents(spark, ODD)).count() == len(ODD)
    left = exact_dedup.drop_copies(documents(spark, ODD))
    assert left.columns == documents(spark, []).columns
    assert sorted((r.doc_id or 0, r.text[:9]) for r in left.collect() if r.text) == [(0, "null id"), (3, " \n\t"), (4, "a"), (6, "same text"), (7, "x x x x x")]


def test_exact_copies_with_clashing_names(spark):
    docs = documents(spark, ODD).selectExpr("*", "'mine' AS __id", "'mine' AS __own", "'mine' AS __sha", "'mine' AS __n")
    left = exact_dedup.drop_copies(docs)
    assert left.columns == docs.columns
    assert {(r["__id"], r["__own"], r["__sha"], r["__n"]) for r in left.collect()} == {("mine",) * 4}
    assert left.count() == exact_dedup.drop_copies(documents(spark, ODD)).count()


# 1: near dedup


def weighted(texts: list[str], weights: np.ndarray) -> list[dict[int, float]]:
    out = []
    for t in texts:
        hashes, first = near_dedup._folded_words(pa.array([t], pa.string()))
        key, weight, _ = near_dedup.shingles(hashes, first, weights)
        out.append(dict(zip(key.tolist(), weight.tolist(), strict=True)))
    return out


def near_edits(n_groups: int, copies: int, edits) -> list[str]:
    """Texts of 120 words in groups; copy ``c`` of a group has ``edits(c)`` words of its own."""
    rng = np.random.default_rng(5)
    texts = []
    for g in range(n_groups):
        base = prose(g, 120)
        for c in range(copies):
            copy = list(base)
            for p in rng.choice(120, edits(c), replace=False):
                copy[p] = f"edit{g}x{c}x{p}"
            texts.append(" ".join(copy))
    return texts


def assert_near_groups_equal_brute_force(spark, texts: list[str]) -> int:
    rows = list(enumerate(texts))
    docs = documents(spark, rows)
    found = {r.doc_id: r for r in near_dedup.near_groups(docs).collect()}
    vectors = weighted(texts, near_dedup.slot_weights(docs.select("text")))
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            a, b = vectors[i], vectors[j]
            low = sum(min(w, b[k]) for k, w in a.items() if k in b)
            if a and b and low / (sum(a.values()) + sum(b.values()) - low) >= 0.8:
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    assert {i: r.component_id for i, r in found.items()} == {i: root(i) for i in range(len(texts))}
    assert sum(r.kept for r in found.values()) == len({root(i) for i in range(len(texts))})
    return len({root(i) for i in range(len(texts))})


def test_near_groups_equal_brute_force(spark):
    texts = near_edits(6, 25, lambda c: c // 3) + ["a b c", "A b C", "alone words here", ""]
    assert_near_groups_equal_brute_force(spark, texts)


def test_members_just_below_the_similarity_are_compared_tile_by_tile(spark, monkeypatch):
    """Copies about as far from each other as the similarity: many components share a bucket, in many small tiles."""
    monkeypatch.setattr(near_dedup, "TILE_MEMBERS", 5)
    compared, inner = [], near_dedup._tile_links
    monkeypatch.setattr(near_dedup, "_tile_links", lambda *x: compared.append(x) or inner(*x))
    texts = near_edits(2, 60, lambda c: 1 + c % 3)
    assert 2 < assert_near_groups_equal_brute_force(spark, texts) < len(texts)
    assert compared


def test_tiles_hold_bounded_groups_and_emit_links_only():
    """One tile pair by itself: unknown leads, an earlier shared bucket, a pair at the similarity."""
    from churn_engine.llm.common import BATCH_ROWS
    import zstandard

    texts = near_edits(1, 12, lambda c: c % 4)
    squeeze = zstandard.ZstdCompressor()
    weights = np.full(near_dedup.SLOTS, 1024, np.int32)
    vectors = weighted(texts, weights)
    total = [sum(v.values()) for v in vectors]
    n = len(texts)
    assert n < BATCH_ROWS
    rows = {
        "band": [1] * n, "bucket": [7] * n, "i": [0] * n, "j": [1] * n, "tile": [k % 2 for k in range(n)], "id": list(range(n)),
        "component": list(range(n)), "common": total, "total": total, "far": [None] * n, "met": [None] * n,
        "bands": [[k if k > 1 else 0, 5] for k in range(n)], "body": [squeeze.compress(t.encode()) for t in texts],
    }
    types = {"far": pa.float64(), "met": pa.float64(), "bands": pa.list_(pa.int64())}
    table = pa.table({k: pa.array(v, types.get(k)) for k, v in rows.items()})
    found = near_dedup._tile_links(weights, 0.8)(table).to_pydict()

    def similar(a, b):
        low = sum(min(w, vectors[b][k]) for k, w in vectors[a].items() if k in vectors[b])
        return low / (total[a] + total[b] - low) >= 0.8

    # 0 and 1 share the bucket of band 0, so they are made there.
    true = {(a, b) for a in range(0, n, 2) for b in range(1, n, 2) if similar(a, b) and (a, b) != (0, 1)}
    assert 0 < len(true) < n * n / 4
    assert {tuple(sorted(x)) for x in zip(found["a"], found["b"], strict=True)} == {tuple(sorted(x)) for x in true}


def test_links_of_tiles_grow_with_members_not_with_pairs():
    """Every text of one component is near every text of the other: one link joins them; what only a third component links stays linked."""
    import zstandard

    texts = near_edits(1, 40, lambda c: 1) + near_edits(2, 4, lambda c: 1)[4:]
    weights = np.full(near_dedup.SLOTS, 1024, np.int32)
    total = [sum(v.values()) for v in weighted(texts, weights)]
    n = len(texts)
    component = [k % 2 for k in range(20)] + list(range(20, 40)) + [99] * 4
    rows = {
        "band": [0] * n, "i": [0] * n, "j": [0] * n, "tile": [0] * n, "id": list(range(n)), "component": component, "common": total,
        "total": total, "far": [None] * n, "met": [None] * n, "bands": [[k, 5] for k in range(n)],
        "body": [zstandard.compress(t.encode()) for t in texts],
    }
    types = {"far": pa.float64(), "met": pa.float64(), "bands": pa.list_(pa.int64())}
    table = pa.table({k: pa.array(v, types.get(k)) for k, v in rows.items()})
    every = near_dedup._tile_links(weights, 0.8)(table).to_pydict()
    few = near_dedup._tile_links(weights, 0.8, True)(table).to_pydict()

    def joined(found):
        name = list(component)
        for a, b in zip(found["a"], found["b"], strict=True):
            name = [name[a] if x == name[b] else x for x in name]
        return {frozenset(k for k in range(n) if name[k] == x) for x in name}

    assert joined(few) == joined(every) == {frozenset(range(40)), frozenset(range(40, 44))}
    assert len(every["a"]) > 500
    assert len(few["a"]) == 21  # 22 components become one


def test_sampler_agrees_as_often_as_texts_are_similar():
    rng = np.random.default_rng(2)
    key = np.sort(rng.integers(1, 2**63, 300).astype(np.uint64))
    a, b = rng.gamma(2, 3, 300).astype(np.float32) + 0.1, rng.gamma(2, 3, 300).astype(np.float32) + 0.1
    b[:200] = a[:200]
    sampler = near_dedup.Sampler(6000)
    one = sampler(np.r_[key, key], np.r_[a, b], np.array([0, 300, 600]))
    agree = (one[0] == one[1]).mean()
    true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs(agree - true**near_dedup.ROWS) < 0.04


def test_near_odd_rows(spark):
    assert near_dedup.near_groups(documents(spark, [])).count() == 0
    found = near_dedup.near_groups(documents(spark, ODD))
    assert found.count() == len(ODD)
    assert {r.doc_id: r.kept for r in found.collect()}[6] is False
    assert near_dedup.drop_near_copies(documents(spark, ODD)).columns == documents(spark, []).columns


def test_near_rows_that_repeat_an_id_have_their_own_texts(spark):
    """Id 5 is a near copy of 1 and, with another text, of 2; with a third text it is alone. Id 3 names a text and a null."""
    first, second, third = (" ".join(prose(k, 100)) for k in (21, 22, 23))
    rows = [(1, first), (2, second), (5, first + " end"), (5, second + " end"), (5, third), (3, third + " x"), (3, None), (7, first), (None, first)]
    docs = documents(spark, rows).withColumn("__id", F.lit("mine")).withColumn("__own", F.lit("mine"))
    assert near_dedup.near_groups(docs).count() == len(rows)
    found = sorted((r.doc_id, r.component_id, r.kept) for r in near_dedup.near_groups(docs).collect() if r.doc_id is not None)
    assert found == [(1, 1, True), (2, 2, True), (3, 3, True), (3, 3, True), (5, 1, False), (5, 2, False), (5, 3, False), (7, 1, False)]
    left = near_dedup.drop_near_copies(docs)
    assert left.columns == docs.columns
    assert sorted((str(r.doc_id), r.text or "") for r in left.collect()) == sorted([("1", first), ("2", second), ("3", third + " x"), ("3", ""), ("None", first)])


# 4: substring dedup


def removed(rows: list[tuple[int, str]]) -> dict[int, list[str]]:
    first: dict[tuple, int] = {}
    split = {i: t.split() for i, t in rows}
    for i in sorted(split):
        for p in range(len(split[i]) - 49):
            first.setdefault(tuple(split[i][p : p + 50]), i)
    out = {}
    for i, w in split.items():
        gone = set()
        for p in range(len(w) - 49):
            if first[tuple(w[p : p + 50])] < i:
                gone.update(range(p, p + 50))
        out[i] = [x for p, x in enumerate(w) if p not in gone]
    return out


def test_cut_repeats_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    passage = prose(99, 130)
    rows = []
    for i in range(60):
        a, n, at = int(rng.integers(0, 80)), int(rng.integers(45, 60)), int(rng.integers(0, 70))
        rows.append((i, " ".join(prose(i, at) + passage[a : a + n] + prose(1000 + i, 40))))
    rows += [(60, rows[3][1]), (61, "a " * 200), (62, "a " * 49), (63, "a\x0b" * 50)]
    found = {r.doc_id: r for r in substring_dedup.cut_repeats(documents(spark, rows)).collect()}
    for i, kept in removed(rows).items():
        assert found[i].kept_text == " ".join(kept)
        assert found[i].n_words - found[i].n_removed == len(kept)
        assert found[i].kept_sha256 == hashlib.sha256(" ".join(kept).encode()).hexdigest()


def test_cover_meets_every_offset():
    for i in range(31):
        for j in range(31):
            assert any(substring_dedup.ON_COVER[(i + d) % 31] and substring_dedup.ON_COVER[(j + d) % 31] for d in range(31))


def test_substring_odd_rows(spark):
    assert substring_dedup.cut_repeats(documents(spark, [])).count() == 0
    assert substring_dedup.cut_repeats(documents(spark, ODD)).count() == len(ODD)
    long = " ".join(prose(1, 60))
    rows = [(None, long), (1, long), (1, long), (2, long + " end"), (3, long)]
    found = [(r.doc_id, r.n_removed) for r in substring_dedup.cut_repeats(documents(spark, rows)).collect()]
    assert sorted(found, key=str) == [(1, 0), (1, 0), (2, 60), (3, 60), (None, 0)]
    kept = substring_dedup.drop_repeats(documents(spark, rows[1:2] + rows[3:]))
    assert [(r.doc_id, r.text, r.n_chars) for r in kept.orderBy("doc_id").collect()] == [(1, long, len(long)), (2, "end", 3)]


def test_substring_rows_that_repeat_an_id_keep_their_own_texts(spark):
    long, other = " ".join(prose(1, 60)), " ".join(prose(2, 60))
    rows = [(1, long), (2, long + " end"), (2, other), (2, long + " end"), (3, other + " tail"), (None, other)]
    docs = documents(spark, rows).withColumn("__id", F.lit("mine")).withColumn("__text", F.lit("mine"))
    kept = substring_dedup.drop_repeats(docs)
    assert kept.columns == docs.columns
    found = sorted((str(r.doc_id), r.text, r.n_chars) for r in kept.collect())
    assert found == sorted((str(i), t, len(t)) for i, t in [(1, long), (2, "end"), (2, "end"), (2, other), (3, "tail"), (None, other)])


# 5: vectors


def test_vector_links_equal_brute_force(spark):
    rng = np.random.default_rng(8)
    base = rng.standard_normal((12, 24))
    rows = []
    for i in range(240):
        x = base[i % 12] + rng.standard_normal(24) * (0.16 if i % 3 else 0.02)
        rows.append((i, [float(v) for v in x], i % 2))
    rows += [(240, rows[4][1], 0), (241, rows[4][1], 1), (242, [v * 7 for v in rows[4][1]], 0)]
    odd = [(243, None, 0), (244, [0.0] * 24, 0), (245, [float("nan")] * 24, 0), (246, [None] * 24, 0), (247, rows[4][1], None), (248, [], 0), (249, [1e-300, -1e-300], 0)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int")
    found = {r.vec_id: r for r in vector_dedup.vector_links(df, tile=32).collect()}
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    links = (x @ x.T >= 0.98) & (label[:, None] == label)
    np.fill_diagonal(links, False)
    root = np.arange(len(rows))
    for _ in range(len(rows)):
        root = np.array([min([root[i], *root[links[i]]]) for i in range(len(rows))])
    assert links.sum() > 100
    assert [found[i].n_links for i in range(len(rows))] == links.sum(axis=1).tolist()
    assert [found[i].component_id for i in range(len(rows))] == root.tolist()
    assert all((found[r[0]].n_links, found[r[0]].component_id, found[r[0]].kept) == (0, r[0], True) for r in odd)
    assert vector_dedup.vector_links(df.limit(0)).count() == 0


def test_quantisation_bound_holds():
    x = vector_dedup.unit(np.random.default_rng(1).standard_normal((200, 48)) ** 3)
    a = vector_dedup.Quantised(x)
    products, bound = a.product(a)
    assert (np.abs(products - x @ x.T) <= bound).all()


# 3 and 9: encoding and packing

ALPHABET = ["a", "B", "é", "Σ", "ς", " ", "  ", "\n", "\u00a0", "\u3000", "e\u0301", "\u0301", "1", "²", "'s", "'LL", "<|endoftext|>", "<|startoftext|>", "中", "😀", "\r\n", "\x00", "\x1c", "×", "ß", "İ", "word", " the", "$$", "\u2028"]


@pytest.mark.parametrize("path", [WORD, BYTE])
@given(texts=st.lists(st.lists(st.sampled_from(ALPHABET), max_size=30).map("".join), min_size=1, max_size=20))
@settings(max_examples=80, deadline=None)
def test_ids_equal_the_tokenizer(path, texts):
    tokenizer = Tokenizer.from_file(path)
    found = list(chunked_bpe.encoded(chunked_bpe.ChunkedBpe(path), pa.array(texts)))
    assert [x.tolist() for x in found] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_round_trip(spark, monkeypatch):
    rows = [*ODD, (8, "Hello <|endoftext|> Wörld's 12 中文 \u0301x"), (9, " ".join(prose(1, 900)))]
    tokenizer = Tokenizer.from_file(WORD)
    found = chunked_bpe.round_trip(documents(spark, rows), WORD).collect()
    assert len(found) == len(rows)
    texts = defaultdict(list)
    for i, t in rows:
        texts[i].append(t or "")
    for r in found:
        ids = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts[r.doc_id]]
        assert r.ids in ids and r.n_tokens == len(r.ids)
        decoded = tokenizer.decode(r.ids, skip_special_tokens=False)
        assert (r.decoded, r.decoded_sha256) == (decoded, hashlib.sha256(decoded.encode()).hexdigest())
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, r.ids)).encode()).hexdigest()
    assert chunked_bpe.round_trip(documents(spark, []), WORD).count() == 0


def test_packing(spark):
    rows = [*ODD, *((100 + i, " ".join(prose(i, 40 + 37 * (i % 23)))) for i in range(150))]
    tokenizer = Tokenizer.from_file(BYTE)
    found = packing.pack_documents(documents(spark, rows), BYTE, 2, block=64).toPandas()
    expected = []
    for i, t in rows:
        raw = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        cuts = [0, *range(len(raw) % 1024 or 1024, len(raw) + 1, 1024)]
        expected += [(-1 if i is None else i, k, a, b - a, zlib.crc32(raw[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]
    got = found.fillna({"doc_id": -1})[["doc_id", "piece", "start", "length", "ids_crc32"]].astype(int).values.tolist()
    assert sorted(map(tuple, got)) == sorted(expected)
    found = found.sort_values(["sequence_id", "offset"])
    sums = found.groupby("sequence_id").length
    assert (sums.cumsum() - found.length == found.offset).all()
    assert sums.sum().max() <= 1024
    least = math.ceil(found.length.sum() / 1024)
    assert found.sequence_id.nunique() <= 1.05 * least + 3
    assert packing.pack_documents(documents(spark, []), BYTE, 2).count() == 0


def test_evolution_never_loses_a_document_and_does_not_get_worse():
    lengths = np.random.default_rng(4).integers(1, 1024, 600)
    rng = np.random.default_rng(1)
    born = packing._born(lengths, rng, 1024, 0.0)
    best = packing.evolve(lengths, [born], [1], 1024, 8, 4)[0]
    assert best.fitness <= born.fitness
    assert best.fills.max() <= 1024 and best.fills.sum() == lengths.sum()


# 2: quality


def test_quality_learns_and_leaves_labels_out(spark):
    rng = np.random.default_rng(6)
    rows, told = [], []
    for i in range(400):
        good = i % 4 != 0
        rows.append((i, " ".join(f"{w}" if good else f"{w}$$" for w in prose(i, int(rng.integers(5, 80))))))
        told.append((i, int(good)))
    labels = spark.createDataFrame([*told, (7, 0), (None, 1), (9999, 1)], "doc_id long, quality int")
    docs = documents(spark, [*rows, (500, None), (501, ""), (None, "x")])
    model = quality.fit(docs, labels)
    found = {r.doc_id: r for r in quality.score(docs, model).collect()}
    assert all(found[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in range(400))
    assert np.mean([found[i].predicted == y for i, y in told]) > 0.97
    assert 0 <= found[500].score == found[501].score <= 1 and found[None].held_out is False
    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality.fit(docs, flipped)
    assert (again.weights == model.weights).all()
    kept = {r.doc_id for r in quality.drop_poor(docs, labels).collect()}
    assert kept == {i for i, r in found.items() if r.score >= quality.THRESHOLD}
    none = quality.fit(docs, labels.limit(0))
    assert quality.score(docs.limit(0), none).count() == 0


def test_dual_coordinate_descent_reaches_the_optimum():
    rng = np.random.default_rng(0)
    rows = [np.sort(rng.choice(50, 8, replace=False)) for _ in range(120)]
    values = [rng.standard_normal(8) / 3 for _ in rows]
    signs = np.where(rng.random(120) < 0.5, 1.0, -1.0)
    w, bias = quality.dual_coordinate_descent(rows, values, signs, epochs=3000)

    def loss(w, bias):
        return 0.5 * (w @ w + bias**2) + sum(max(0, 1 - s * (w[r] @ v + bias)) for r, v, s in zip(rows, values, signs, strict=True))

    least = loss(w, bias)
    for _ in range(200):
        assert loss(w + 0.01 * rng.standard_normal(len(w)) * (np.arange(len(w)) < 50), bias + 0.01 * rng.standard_normal()) >= least - 1e-3


# 6: WARC


def test_archives(spark, tmp_path):
    same = "<p>é</p>" * 200
    rows = [(i, f"http://x/{i}\r\nX: y", same if i % 3 == 0 else f"<html>{i} {'body ' * (i % 40)}</html>") for i in range(300)]
    rows += [(300, None, None), (301, "u", ""), (None, "n", same), (302, "u", "a" * 999), (303, "u", "a" * 999)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, kind int")
    archives = warc.write_archives(df, f"file://{tmp_path}/archives", archive_bytes=40_000)
    listed = archives.collect()
    assert len(listed) > 2 and sum(r.records for r in listed) == len(rows)
    found = {r.page_id: r for r in warc.read_archives(archives).collect()}
    assert len(found) == len(rows)
    for page, _, html in rows:
        raw = (html or "").encode()
        kind = "revisit" if html == same and page != 297 else "response"
        r = found[page]
        assert (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) == (len(raw), hashlib.sha1(raw).hexdigest(), kind, 297 if kind == "revisit" else None)
    assert warc.archive_and_read(df.limit(0)).count() == 0


def test_dictionary_stands_in_a_leading_frame(tmp_path):
    path = f"file://{tmp_path}/a.warc.zst"
    writer = warc.ArchiveWriter(path)
    raws = [warc.record(i, "u", f"<html>{i} common words of all pages</html>".encode() * 20, "d", None, "response", 1) for i in range(400)]
    for raw in raws:
        writer.add(raw)
    writer.close()
    assert (tmp_path / "a.warc.zst").read_bytes()[:4] == bytes.fromhex("5d2a4d18")
    assert list(warc.read_archive(path)) == raws


# 7: licences


def test_licenses(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [
        (1, "a/LICENSE", mit),
        (2, "a/b/x.txt", "Some text.\nmore"),
        (3, "a/b/c/LICENSE", gpl),
        (4, "a/b/c/d/y.txt", "text"),
        (5, "a/z.txt", "long text that goes on and on, line one\nand two, three\n" * 4 + gpl),
        (6, "q/none.txt", "the public work of a version is under this"),
        (7, None, "x"),
        (8, "a/empty", None),
        (9, "top.txt", "license"),
        (10, "a/b/c/d/y.txt", ""),
    ]
    df = spark.createDataFrame([(*r, "l") for r in rows], "doc_id long, path string, text string, license string")
    found = {r.doc_id: (r.license, r.found_in, r.covered_by) for r in license_scan.scan_licenses(df, "doc_id").collect()}
    assert found == {
        1: ("MIT", "file", None),
        2: ("MIT", "directory", "a"),
        3: ("GPL-3.0", "file", None),
        4: ("GPL-3.0", "directory", "a/b/c"),
        5: ("GPL-3.0", "line", None),
        6: (None, None, None),
        7: (None, None, None),
        8: ("MIT", "directory", "a"),
        9: (None, None, None),
        10: ("GPL-3.0", "directory", "a/b/c"),
    }
    assert license_scan.scan_licenses(df.limit(0), "doc_id").count() == 0


def test_key_words_miss_no_line():
    idf = {w: 1 + (hash(w) % 7) / 3 for _, t in license_scan.TEMPLATES for w in license_scan._template_tokens(t)}
    keys = set(license_scan.key_words(license_scan.TEMPLATES, idf, 0.6))
    for _, text in license_scan.TEMPLATES:
        counted = license_scan._template_tokens(text)
        whole = sum((n * idf[w]) ** 2 for w, n in counted.items())
        assert sum((n * idf[w]) ** 2 for w, n in counted.items() if w not in keys) < 0.36 * whole


def own_licenses(spark, texts: list[str]) -> list[str | None]:
    """Licences of texts among a hundred others, which lie in no directory."""
    rows = [(i, None, t) for i, t in enumerate([*texts, *prose(5, 100)])]
    df = spark.createDataFrame(rows, "file_id long, path string, text string")
    found = {r.file_id: r.license for r in license_scan.scan_licenses(df).collect()}
    assert all(found[i] is None for i in range(len(texts), len(rows)))
    return [found[i] for i in range(len(texts))]


def test_licenses_of_headers_spans_and_ids(spark):
    filler = " ".join(prose(6, 80))
    cases = {
        "x = 1\n# SPDX-License-Identifier: MIT\n": "MIT",
        "// SPDX-License-Identifier: Apache-2.0\nint x;": "Apache-2.0",
        "The MIT License (MIT)\n" + filler: "MIT",
        filler + " Released under the MIT License. " + filler: "MIT",
        filler + " Licensed under CC BY-NC 4.0. " + filler: "CC-BY-NC-4.0",
        "// This Source Code Form is subject to the terms of the Mozilla Public\n// License, v. 2.0. If a copy of the MPL was not distributed with this\n"
        "// file, You can obtain one at https://mozilla.org/MPL/2.0/.\nint x;\n" + filler: "MPL-2.0",
        "/* This program is free software; you can redistribute it and/or modify\n it under the terms of the GNU General Public License as published by\n"
        " the Free Software Foundation; either version 2 of the License, or\n (at your option) any later version. */\n" + filler: "GPL-2.0",
        dict(license_scan.full_texts())["MIT"].replace("\n", "\n# ") + "\nx = 1\n" + filler: "MIT",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
        "This work is licensed under the GNU General Public License, version 4.": None,
        "Licensed under the Apache License, Version 1.1.": None,
        "Released under the ISC License.": None,
        filler: None,
    }
    assert dict(zip(cases, own_licenses(spark, list(cases)), strict=True)) == cases


def brute_license(texts: dict[int, str]) -> dict[int, tuple[str, float] | None]:
    """The most similar template of any line, any run of a notice's length, and the whole text, by plain cosine."""
    terms = license_scan._template_tokens
    everything = [*license_scan.TEMPLATES, *license_scan.full_texts()]
    vocabulary = {w for _, t in everything for w in terms(t)}
    df = defaultdict(int)
    for text in texts.values():
        for w in set(terms(text)) & vocabulary:
            df[w] += 1
    idf = {w: 1 + math.log((1 + len(texts)) / (1 + df[w])) for w in vocabulary}
    rarest = max(idf.values())

    def similarity(piece: str, i: int) -> float:
        name, template = everything[i]
        a = {w: n * idf.get(w, rarest) for w, n in terms(piece).items()}
        b = {w: n * idf[w] for w, n in terms(template).items()}
        if not set(license_scan._needed(name, template)) <= set(a):
            return 0.0
        return sum(x * b.get(w, 0) for w, x in a.items()) / math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values())) if a else 0.0

    found = {}
    for key, text in texts.items():
        run = re.findall("[a-z0-9]+", text.lower())
        scores = []
        for i, (name, template) in enumerate(everything):
            is_full, n = i >= len(license_scan.TEMPLATES), len(re.findall("[a-z0-9]+", template.lower()))
            spans = [] if is_full else [" ".join(run[k : k + n]) for k in range(max(1, len(run) - n + 1))]
            for whole, piece in [(False, x) for x in {*text.split("\n"), *spans}] + [(True, text)] * is_full:
                if (x := round(similarity(piece, i), 6)) >= license_scan.COSINE:
                    scores.append((not whole, -x, name))
        found[key] = (min(scores)[2], -min(scores)[1]) if scores else None
    return found


def test_licenses_equal_brute_force(spark):
    """Notices whole, cut, mixed and with words changed, in texts of fewer words than a notice up to many blocks of it."""
    rng = np.random.default_rng(11)
    short = [t for _, t in license_scan.TEMPLATES if len(t) < 120]
    texts = {}
    for i in range(150):
        parts = []
        for _ in range(rng.integers(1, 5)):
            notice = short[rng.integers(len(short))].split()
            notice = [w if rng.random() > 0.12 * (i % 4) else f"w{rng.integers(40)}" for w in notice][rng.integers(0, 3) :]
            parts += [" ".join(notice), " ".join(prose(1000 + 7 * i + len(parts), int(rng.integers(0, 60))))]
        texts[i] = "".join(x + ("\n" if rng.random() < 0.4 else " ") for x in (parts if i % 3 else parts[1:2]))
    texts[150], texts[151] = dict(license_scan.full_texts())["BSD-2-Clause"], "mit " * 300 + "der die das " * 300
    df = spark.createDataFrame([(i, None, t) for i, t in texts.items()], "file_id long, path string, text string")
    got = {r.file_id: None if r.license is None else (r.license, r.similarity) for r in license_scan.scan_licenses(df).collect()}
    want = brute_license(texts)
    assert 30 < sum(x is not None for x in want.values()) < 150
    assert {i: x and x[0] for i, x in got.items()} == {i: x and x[0] for i, x in want.items()}
    assert all(abs(got[i][1] - x[1]) <= 2e-6 for i, x in want.items() if x)


def test_full_license_texts_cover_their_directories(spark):
    full = dict(license_scan.full_texts())
    rows = [
        (1, "m/LICENSE", "MIT License\n\nCopyright (c) 2020 Some One\n\n" + full["MIT"]),
        (2, "m/src/a.py", "x = 1\n"),
        (3, "m/vendor/terms", full["Apache-2.0"]),
        (4, "m/vendor/lib/b.c", "int x;\n"),
        (5, "n/a.py", "y = 2\n# Released under the MIT License.\n" + " ".join(prose(7, 80))),
        (6, "n/b.py", "z = 3\n"),
        *[(10 + i, f"t/{name}/text", text) for i, (name, text) in enumerate(sorted(full.items()))],
        *[(100 + i, None, t) for i, t in enumerate(prose(8, 50))],
    ]
    df = spark.createDataFrame(rows, "file_id long, path string, text string")
    found = {r.file_id: (r.license, r.found_in, r.covered_by) for r in license_scan.scan_licenses(df).collect()}
    assert found[1] == ("MIT", "file", None) and found[2] == ("MIT", "directory", "m")
    assert found[3] == ("Apache-2.0", "file", None) and found[4] == ("Apache-2.0", "directory", "m/vendor")
    assert found[5] == ("MIT", "line", None) and found[6] == (None, None, None)
    assert [found[10 + i][:2] for i in range(len(full))] == [(name, "file") for name in sorted(full)]


# 8: URLs


def test_urls(spark):
    rules = spark.createDataFrame([("org", "/", "allow"), ("Example.org", "/es/", "block"), ("example.org", "/en/1", "block"), (None, "/", "block"), ("x.y", "", "block")], "host string, path string, verdict string")
    cases = {
        "http://a.EXAMPLE.org/es/1?q#f": ("a.example.org", "/es/1", "example.org/es/", "block"),
        "https://example.org/en/12": ("example.org", "/en/12", "example.org/en/1", "block"),
        "https://example.org/en/2": ("example.org", "/en/2", "org/", "allow"),
        "https://notexample.org?x=/es/": ("notexample.org", "", None, "allow"),
        "https://myorg/": ("myorg", "/", None, "allow"),
        "ftp://x.y": ("x.y", "", "x.y", "block"),
        "no scheme": ("", "", None, "allow"),
        "://": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "http://É.org/a://b": ("É.org", "/a://b", "org/", "allow"),
    }
    rows = [(i, u, "h") for i, u in enumerate(cases)] + [(0, next(iter(cases)), "h")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string")
    found = url_filter.judge_urls(df, rules).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r.host, r.path, r.rule, r.verdict) == list(cases.values())[r.page_id]
    assert url_filter.judge_urls(df.limit(0), rules).count() == 0
    assert {r.verdict for r in url_filter.judge_urls(df, rules.limit(0), default="block").collect()} == {"block"}


def test_url_filter_grows_with_the_list(spark, monkeypatch):
    """Of a long list every listed key passes and few others do, whether the filter is broadcast or joined like a table."""
    n = 200_000
    listed = spark.range(n).select(F.concat(F.lit("h"), "id", F.lit(".org\n/")).alias("key"))
    others = spark.range(n).select(F.concat(F.lit("x"), "id", F.lit(".org\n/")).alias("key"))
    for bound in (url_filter.BROADCAST_BLOCKS, 10):
        monkeypatch.setattr(url_filter, "BROADCAST_BLOCKS", bound)
        assert url_filter.passed(listed, listed, n).count() == n
        assert 0 < url_filter.passed(others, listed, n).count() < n / 50
    rules = spark.range(n).select(F.concat(F.lit("h"), "id", F.lit(".org")).alias("host"), F.lit("/").alias("path"), F.lit("block").alias("verdict"))
    pages = spark.range(0, 2 * n, 2).select(F.col("id").alias("page_id"), F.concat(F.lit("http://a.h"), "id", F.lit(".org/p")).alias("url"))
    found = url_filter.judge_urls(pages, rules).groupBy("verdict").count().collect()
    assert {r.verdict: r["count"] for r in found} == {"block": n // 2, "allow": n // 2}


# the pipeline


def test_pipeline_stages_keep_columns_and_decide(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counts = [docs.count()]
    folder = shared_folder(spark)
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        if i < 4:
            assert out.schema.names == docs.schema.names
        out.write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
        counts.append(docs.count())
    assert counts[1] < counts[0] and counts[2] < counts[1] and counts[3] < counts[2] and counts[4] <= counts[3]
    assert docs.select("doc_id").distinct().count() == counts[4]
