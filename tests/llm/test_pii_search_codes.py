"""Personal data, ranked search and vector codes against brute force."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from churn_engine.llm import lexical_search, pii, vector_codes

DOCS = "doc_id long, text string, id int, h string, kind string, text_2 string"


def documents(spark, rows):
    """Documents with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, 1, "h", "k", None) for i, t in rows], DOCS)


# 11: personal data

PLAIN = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]
KINDS = ["email", "ip", "card", "phone"]
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def passes(kind: int, value: str) -> bool:
    digits = re.sub("[^0-9]", "", value)
    if kind == 1:
        return all(int(x) <= 255 for x in value.split("."))
    if kind == 2:
        doubled = [int(c) if i % 2 == 0 else int(c) * 2 - 9 * (c > "4") for i, c in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == 0 or 9 <= len(digits) <= 15


def plain_base(text: str | None) -> list[tuple[int, int, int]]:
    return sorted((m.start(), k, m.end()) for k, p in enumerate(PLAIN) for m in re.finditer(p, text or "") if passes(k, m.group()))


def lowered(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def plain_spans(rows: list[tuple]) -> list[list[tuple[int, str, int]]]:
    """The whole method, document by document."""
    terms = [set(x for x in re.findall(TERM, lowered(t or "")) if len(x) >= 3) for _, t in rows]
    keys = [s | {x[:3] + "*" for x in s} for s in terms]
    df = Counter(k for s in keys for k in s)
    near, holds = defaultdict(dict), defaultdict(set)
    for n, (_, text) in enumerate(rows):
        by_kind = {k: [m for m in re.finditer(PLAIN[k], text or "")] for k in range(4)}
        for kind, found in by_kind.items():
            for i, m in enumerate(found):
                if not passes(kind, m.group()):
                    continue
                a, b = (found[i - 1].end() if i else 0), (found[i + 1].start() if i + 1 < len(found) else len(text))
                left, right = text[a : m.start()], text[m.end() : b]
                left = re.sub(f"^{TERM}", "", left[-100:]) if len(left) > 100 else left
                right = re.sub(f"{TERM}$", "", right[:100]) if len(right) > 100 else right
                entity = (kind, lowered(m.group()) if kind == 0 else m.group() if kind == 1 else re.sub("[^0-9]", "", m.group()))
                holds[entity].add(n)
                here = {x for x in re.findall(TERM, lowered(left + " " + right)) if len(x) >= 3}
                for key in here | {x[:3] + "*" for x in here}:
                    near[entity, key].setdefault(n, set()).add((left, right))
    replaced: dict[str, set] = defaultdict(set)

    def copied(entity, key) -> bool:
        around = {x for s in near[entity, key].values() for x in s}
        terms = [{x for x in re.findall(TERM, lowered(a + " " + b)) if len(x) >= 3} - {key} for a, b in around]
        w = Counter(x for s in terms for x in s)
        return sum(c * (c - 1) for c in w.values()) > 0.5 * (len(around) - 1) * w.total()

    def gives_away(entity, key) -> bool:
        together, both = near[entity, key], len(holds[entity])
        if both >= len(rows):
            return False
        if copied(entity, key):
            return False
        return math.log2(len(rows) * len(together) / (df[key] * both)) >= 0.9 * math.log2(len(rows) / both) - 1e-9

    for (entity, key), where in list(near.items()):
        # One surrounding for each document suffices here: no fixture has two of one entity in a text.
        if not key.endswith("*") and len({x for s in where.values() for x in s}) >= 3 and gives_away(entity, key):
            replaced[key].add(gives_away(entity, key[:3] + "*"))
    out = []
    for _, text in rows:
        spans = [(a, KINDS[k], b) for a, k, b in plain_base(text)]
        for m in re.finditer(TERM, text or ""):
            told = replaced.get(lowered(m.group()))
            if told:
                spans.append((m.start(), "removed" if True in told else "generalised", m.end()))
        out.append(sorted(spans, key=lambda s: (s[0], pii.KINDS.index(s[1]))))
    return out


def entities() -> list[tuple[int | None, str | None]]:
    rng = np.random.default_rng(5)
    words = [f"{a}{b}{c}" for a in ("lor", "qui", "su", "Ün", "kap") for b in ("em", "t", "d", "o", "ni", "ra") for c in ("", "a", "en", "ö", "ist", "es", "um")]
    prose = lambda n: " ".join(rng.choice(words, n))
    rows: list[tuple[int | None, str | None]] = [(i, prose(int(rng.integers(5, 60)))) for i in range(150)]
    rows += [(200 + i, f"{prose(8)} Zorblat Quix wrote to j.d+x@mail.example.org, {prose(6)}") for i in range(4)]  # a name that tells the address
    rows += [(210 + i, f"{prose(7)} quixote {prose(3)}") for i in range(9)]  # shares a beginning with the second name
    rows += [(220, f"{prose(3)} ZORBLAT alone here"), (221, "call +49 (30) 1234-5678. or 10.0.0.255 and 1.2.3.999")]
    rows += [(230 + i, "same passage Vexel speaks v@w.example here") for i in range(6)]  # copies tell nothing
    edited = prose(30).split()
    rows += [(250 + i, " ".join([*edited[: 2 * i], "w%d" % i, *edited[2 * i + 1 : 15], "Norvig n@w.example", *edited[15:]])) for i in range(6)]  # near copies
    rows += [(240, "card 4111 1111 1111 1111, not 4111 1111 1111 1112; 1-2-3"), (241, "a@b.cd%x@e.fg @x.y a@b ..@c.d.e- 1.2.3.4.5.6.7.8")]
    rows += [(242, "𝒳 ünï x@y.zz +1234567890"), (243, None), (244, ""), (None, "null id a@b.cc"), (245, "0001.002.3.4 +1 2"), (246, "x@y.zz"), (246, "x@y.zz")]
    return rows


def test_personal_data_equals_brute_force(spark):
    rows = entities()
    expected = plain_spans(rows)
    assert {"generalised", "removed"} <= {k for s in expected for _, k, _ in s}
    found = defaultdict(list)
    for r in pii.personal_data(documents(spark, rows)).collect():
        found[r.doc_id].append(r)
    assert sum(map(len, found.values())) == len(rows)
    for (i, text), spans in zip(rows, expected, strict=True):
        base = plain_base(text)
        digest = hashlib.sha256(",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in base).encode()).hexdigest()
        for r in found[i]:
            assert r.spans == ",".join(f"{k}:{a}:{b}" for a, k, b in spans), text
            assert (r.base_sha256, [r.n_email, r.n_ip, r.n_card, r.n_phone]) == (digest, [sum(x[1] == k for x in base) for k in range(4)])


def test_keys_are_counted_before_they_are_joined(spark):
    """The join with the keys asked for makes no row for each text and key."""
    rows = [(i, f"alpha Beta gamma{i % 3} alpha x") for i in range(30)] + [(31, None)]
    texts = pii._texts(documents(spark, rows), "doc_id", "text")
    asked = spark.createDataFrame([("alpha",), ("alp*",), ("gamma1",), ("missing",)], "key string")
    counts = pii._document_frequencies(texts, asked)
    assert {r.key: r.df for r in counts.collect()} == {"alpha": 30, "alp*": 30, "gamma1": 10}
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate") < plan.index("Generate")


def test_sanitised_texts(spark):
    rows = entities()
    docs = documents(spark, rows)
    out = pii.sanitised(docs)
    assert out.columns == docs.columns
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[243] is None and texts[244] == "" and texts[None] == "null id [EMAIL]"
    assert texts[240] == "card [CARD], not 4111 1111 1111 1112; 1-2-3"
    assert texts[242] == "𝒳 ünï [EMAIL] [PHONE]"
    assert texts[253].count("Norvig [EMAIL]") == 1
    assert texts[230] == "same passage Vexel speaks [EMAIL] here"
    assert re.fullmatch(r".*  qui\*  to \[EMAIL\], .*", texts[200]) and texts[220].endswith("  alone here")
    plain = {i: t for i, t in rows}
    assert all(texts[i] == plain[i] for i in range(150))


@given(st.lists(st.text("ab.@-%+ 019()\n", max_size=40), min_size=1, max_size=25))
@settings(max_examples=8, deadline=None)
def test_base_spans_of_random_texts(spark, texts):
    rows = list(enumerate(texts))
    found = {r.doc_id: r.base_sha256 for r in pii.personal_data(documents(spark, rows)).collect()}
    for i, t in rows:
        assert found[i] == hashlib.sha256(",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in plain_base(t)).encode()).hexdigest(), t


def test_personal_data_odd_tables(spark):
    assert pii.personal_data(documents(spark, [])).count() == 0
    assert pii.sanitised(documents(spark, [])).count() == 0
    long = [(1, "a" * 300_000), (2, "1" * 300_000), (3, "1 " * 100_000), (4, "a@b.c " * 3000), (5, "+1" + " " * 100_000), (6, "x." * 100_000 + "@" + "y." * 100_000)]
    found = {r.doc_id: r for r in pii.personal_data(documents(spark, long)).collect()}
    assert [found[i].n_email for i, _ in long] == [0, 0, 0, 3000, 0, 1]
    assert found[4].spans.startswith("email:0:5,email:6:11,") and found[6].spans == "email:0:400000"


# 12: ranked search


def plain_ranks(docs: list[tuple], items: list[tuple], k: int = 20) -> set[tuple]:
    split = lambda t: re.findall(TERM, lowered(t or ""))
    held = [(i, Counter(split(t))) for i, t in docs]
    total = sum(c.total() for _, c in held)
    n = sum(1 for _, c in held if c)
    df = Counter(t for _, c in held for t in c)
    out = set()
    for item, text in set(items):
        scores = []
        for i, c in held:
            if not c:
                continue
            m = 100 - 25 + (25 * c.total() * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m)) for t in split(text))
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out |= {(item, rank + 1, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scores)[:k])}
    return out


@pytest.mark.parametrize("seed,n,parts", [(1, 60, 3), (2, 6000, 1), (3, 500, 7)])
def test_ranked_search_equals_brute_force(spark, seed, n, parts):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(300)] + ["Über", "ÜBER", "ABC", "abc", "ñ7"]
    weight = 1 / np.arange(1, len(words) + 1)
    prose = lambda k: "; ".join(rng.choice(words, k, p=weight / weight.sum()))
    docs = [(i, prose(int(rng.integers(0, 30)))) for i in range(n)]
    docs += [(n, None), (n + 1, ""), (n + 2, " .;"), (None, prose(9)), (5, prose(9)), (5, docs[5][1]), (n + 4, "w1 " * 5000)]
    docs += [(n + 10 + i, docs[7][1]) for i in range(40)]  # ties
    items = [(i, prose(8)) for i in range(40)] + [(40, None), (41, ""), (42, "nothing has this"), (43, docs[7][1]), (3, prose(4)), (44, "w0 w0 w0 w299"), (44, "w0 w0 w0 w299")]
    table = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id int, text string, doc_id string, rank int")
    found = lexical_search.ranked_search(documents(spark, docs).repartition(parts), table).collect()
    assert {(r.item_id, r["rank"], r.doc_id, r.score) for r in found} == plain_ranks(docs, items)


def test_ranked_search_odd_tables(spark):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert lexical_search.ranked_search(documents(spark, []), items).count() == 0
    assert lexical_search.ranked_search(documents(spark, [(1, "a")]), items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]
    assert lexical_search.ranked_search(documents(spark, [(1, None), (2, "..")]), items).count() == 0


def test_descent_drops_ranges():
    """Where one document is far ahead, most cells are never looked at; the result is that of all cells."""
    rng = np.random.default_rng(0)
    rows, columns = np.repeat(np.arange(8), 4096), np.tile(np.arange(4096), 8)
    impacts = rng.integers(1, 10, len(rows))
    impacts[columns == 77] = 1000
    grid = lexical_search.Grid(rows, columns, impacts)
    assert len(grid.best) < 2.4 * len(rows) and grid.best[0] == 1000

    class Counted(lexical_search.Best):
        seen = 0

        def add(self, item, *rest):
            self.seen += len(item)
            super().add(item, *rest)

    best = Counted(1, 1)
    lexical_search.descend(grid, np.array([0, 8]), np.arange(8), np.ones(8, np.int64), np.array([0]), best, np.arange(4096), np.zeros(4096, bool))
    assert (best.id.tolist(), best.score.tolist()) == ([77], [8000]) and best.seen < 64


# 13: vector codes


def plain_codes(vectors: list[tuple]) -> tuple[dict, str]:
    order = sorted(range(len(vectors)), key=lambda i: (vectors[i][0] is None, vectors[i][0] or 0, [math.floor(4096 * c) for c in vectors[i][1]]))
    x = np.array([[math.floor(4096 * c) for c in v] for _, v in vectors], np.int64)
    codes, error, books = [], np.zeros(len(x), np.int64), []
    for part in np.split(x, 8, axis=1):
        book = part[order[:16]].copy()
        for r in range(7):
            d = ((part[:, None] - book[None]) ** 2).sum(axis=2)
            own = d.argmin(axis=1)
            for e in range(len(book)):
                if r < 6 and (own == e).any():
                    book[e] = part[own == e].sum(axis=0) // (own == e).sum()
        codes.append(own)
        error += d.min(axis=1)
        books.append(book)
    digest = hashlib.sha256(",".join(str(c) for b in books for c in b.ravel()).encode()).hexdigest()
    return [("".join(f"{c:02x}" for c in row), int(e)) for row, e in zip(np.array(codes).T, error, strict=True)], digest


@pytest.mark.parametrize("n,scale", [(5, 1.0), (40, 1.0), (5000, 0.3), (300, 9000.0)])
def test_vector_codes_equal_brute_force(spark, n, scale):
    rng = np.random.default_rng(n)
    x = (rng.normal(size=(n, 16)) * scale).astype(np.float32)
    x[n // 2 :: 7] = x[1]  # copies
    good = [(int(i) - 3, [float(c) for c in v], int(i) % 3 if i % 5 else None) for i, v in enumerate(x)]
    good += [(None, [0.5 * scale] * 16, 1), (7, [0.25 * scale] * 16, 1), (7, [-0.25 * scale] * 16, 2)]
    bad = [(100, None, 1), (101, [], 1), (102, [None] * 16, 1), (103, [float("nan")] * 16, 1), (104, [float("inf")] + [0.0] * 15, 0), (105, [1e30] * 16, 0), (106, [1.0] * 8, 0)]
    rows = [(i, v, l, "x", "y") for i, v, l in good + bad]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, id string, x string").repartition(3)
    expected, digest = plain_codes([(i, v) for i, v, _ in good])
    total = defaultdict(int)
    for (_, _, label), (_, error) in zip(good, expected, strict=True):
        total[label] += error
    want = Counter((i, code, error, total[label], digest) for (i, _, label), (code, error) in zip(good, expected, strict=True))
    assert Counter(tuple(r) for r in vector_codes.vector_codes(df).collect()) == want


def test_vector_codes_odd_tables(spark):
    kind = "vec_id long, embedding array<float>, label string"
    empty = vector_codes.vector_codes(spark.createDataFrame([(1, None, "a")], kind))
    assert empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and empty.count() == 0
    with pytest.raises(ValueError):
        vector_codes.vector_codes(spark.createDataFrame([(1, [1.0] * 9, "a")], kind))


@pytest.mark.parametrize("spread", [0.02, 1.0])
def test_balls_are_owned_whole(spread):
    """Trees hold each point once, balls hold their points, and near clusters whole balls go to an entry unseen."""
    rng = np.random.default_rng(1)
    middles = rng.integers(-4000, 4000, (16, 8))
    points = (middles[rng.integers(0, 16, 3000)] + rng.normal(size=(3000, 8)) * 1000 * spread).astype(np.int64)
    order, start, end, left, right = vector_codes.shape(points)
    assert sorted(order.tolist()) == list(range(3000)) and (start[0], end[0]) == (0, 3000)
    tree = vector_codes.Tree(points[order], start, end, left, right)
    for i in range(len(start)):
        own = tree.points[start[i] : end[i]]
        assert (tree.sum[i] == own.sum(axis=0)).all() and np.sqrt(((own - tree.centre[i]) ** 2).sum(axis=1)).max() <= tree.radius[i]
        assert left[i] < 0 or (start[left[i]], end[left[i]], end[right[i]]) == (start[i], start[right[i]], end[i])
    balls, owner, at, nearest = vector_codes.owners(tree, middles)
    found = np.empty(3000, np.int64)
    for ball, e in zip(balls, owner, strict=True):
        found[start[ball] : end[ball]] = e
    found[at] = nearest
    assert (found == vector_codes.squared(tree.points, middles).argmin(axis=1)).all()
    assert len(at) < (100 if spread < 1 else 3000)
