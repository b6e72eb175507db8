"""Personal data: patterns first, then what the corpus tells about them.

Built-in functions only. Base spans are what four patterns match. The text between two matches is cut
off with ``split``, so a running sum of lengths gives every place without a function of our own.

Information-theoretic sanitisation then looks for terms that give a protected entity (a base span's value) away. With the
probabilities p taken over all documents, a term t near an entity e tells PMI(t; e) = log p(t, e) / (p(t) p(e)) about it, and
at most IC(e) = -log p(e). Where the share PMI / IC reaches the threshold, t all but names e. Such a term is generalised to the class
of terms with the same beginning, unless the class gives e away as well: then it is removed. Both happen wherever the term occurs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churn_engine.llm.common import store

KINDS = ("email", "ip", "card", "phone", "generalised", "removed")
BASE = 4
#: The patterns, without ways back: a match is found in time linear in the text. An e-mail starts where a run of its letters starts or where
#: the last one ended; a run of digits before a dot starts at its first digit; the others are as given.
PATTERNS = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[\x20-]?+[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
#: Terms and what parts them. Bytes 00-2F, 3A-40, 5B-60, 7B-7F are outside.
TERM, OUTSIDE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Characters on each side of a span whose whole terms are near it, shortest term, and length of a class's beginning.
NEAR, SHORTEST, BEGINNING = 100, 3, 3
#: Different surroundings in which a term must stand near an entity, and the share of the entity's information that it may tell.
SUPPORT, DISCLOSURE = 3, 0.9
#: The share of its other terms that such a surrounding has in common with another one, on average; near copies of a passage share more.
SHARED = 0.5

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def _class(term: Column) -> Column:
    return F.concat(F.substring(term, 1, BEGINNING), F.lit("*"))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, h, text): rows with equal id and text have one key."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("h"), text.alias("text"))


def _matches(pattern: str, may_match: Column) -> Column:
    return F.when(may_match, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))


def _pieces(texts: DataFrame, patterns: list[tuple[int, str, Column]]) -> DataFrame:
    """(id, h, kind, copies, start, end, value, left, right) of all matches; equal rows are counted in ``copies``.

    ``patterns`` holds (kind, pattern, test without which nothing matches).
    """
    found = [(kind, pattern, _matches(pattern, test)) for kind, pattern, test in patterns]
    some = F.lit(False)
    for _, _, m in found:
        some = some | (F.size(m) > 0)
    kinds = F.array(
        *[
            F.struct(F.lit(kind).alias("kind"), m.alias("m"), F.when(F.size(m) > 0, F.split("text", pattern, -1)).alias("gaps"))
            for kind, pattern, m in found
        ]
    )
    rows = texts.where(some).select("id", "h", F.inline(kinds)).where(F.size("m") > 0)
    gap = lambda i: F.get("gaps", i)
    # A term that the cut goes through is not near.
    left = lambda i: F.when(F.length(gap(i)) > NEAR, F.regexp_replace(F.right(gap(i), F.lit(NEAR)), f"^{TERM}", "")).otherwise(gap(i))
    right = lambda i: F.when(F.length(gap(i)) > NEAR, F.regexp_replace(F.left(gap(i), F.lit(NEAR)), f"{TERM}$", "")).otherwise(gap(i))
    entry = lambda v, i: F.struct(
        i.alias("pos"), F.length(gap(i)).cast("long").alias("before"), F.length(v).cast("long").alias("n"), v.alias("value"), left(i).alias("left"), right(i + 1).alias("right")
    )
    rows = rows.select("id", "h", "kind", F.inline(F.transform("m", entry)))
    rows = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies"))
    so_far = Window.partitionBy("id", "h", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("before") + F.col("n")).over(so_far)
    return rows.withColumn("end", end).select("id", "h", "kind", "copies", (F.col("end") - F.col("n")).alias("start"), "end", "value", "left", "right")


def _valid() -> Column:
    value = F.col("value")
    small = lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255)
    ip = F.forall(F.split(value, r"\."), lambda p: small(F.regexp_replace(p, "^0+", "")))
    digits = F.translate(value, " -", "")
    backwards = F.reverse(digits)
    digit = lambda i: F.substring(backwards, i, F.lit(1)).cast("int")
    doubled = lambda i: F.when(i % 2 == 1, digit(i)).when(digit(i) > 4, digit(i) * 2 - 9).otherwise(digit(i) * 2)
    luhn = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda total, i: total + doubled(i)) % 10 == 0
    card = F.when(F.length(digits).between(12, 19), luhn).otherwise(F.lit(False))
    phone = F.length(F.regexp_replace(value, "[^0-9]", "")).between(9, 15)
    return F.when(F.col("kind") == 0, F.lit(True)).when(F.col("kind") == 1, ip).when(F.col("kind") == 2, card).otherwise(phone)


def base_spans(texts: DataFrame) -> DataFrame:
    """The matches of the four patterns that pass their tests, as ``_pieces`` gives them."""
    text = F.col("text")
    digits = text.rlike("[0-9]")
    tests = (text.contains("@"), digits & text.contains("."), digits, text.contains("+"))
    return _pieces(texts, [(k, p, t) for k, (p, t) in enumerate(zip(PATTERNS, tests, strict=True))]).where(_valid())


def _keys(text: Column) -> Column:
    """The different terms of a text and their classes."""
    terms = F.filter(F.array_distinct(F.split(_lower(text), OUTSIDE, -1)), lambda t: F.length(t) >= SHORTEST)
    return F.array_distinct(F.concat(terms, F.transform(terms, _class)))


def _document_frequencies(texts: DataFrame, asked: DataFrame) -> DataFrame:
    """(key, df) of the keys asked for: the texts that hold them. Keys are counted first, so the join makes a row for each key, not for
    each text and key."""
    return texts.select(F.explode(_keys(F.col("text"))).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("df")).join(asked, "key")


def _apart(both: DataFrame, around: DataFrame, on: list[str]) -> DataFrame:
    """``both`` without what gives an entity away only in near copies of one passage.

    If w of n surroundings hold a term, w (w - 1) pairs share it. All pairs' shared terms over all terms of all pairs is the average share,
    from counts alone.
    """
    one = around.select("kind", "entity", "around", "key").distinct()
    asked = both.where("gives_away").select(*on)
    inside = one.join(asked, on).select("kind", "entity", "around", F.col("key").alias("term"))
    others = inside.join(one.where(~F.col("key").endswith("*")), ["kind", "entity", "around"]).where(~F.col("key").eqNullSafe(F.col("term")))
    w = others.groupBy("kind", "entity", "term", "key").agg(F.count(F.lit(1)).alias("w"))
    shared = w.groupBy("kind", "entity", "term").agg(F.sum(F.col("w") * (F.col("w") - 1)).alias("pairs"), F.sum("w").alias("terms"))
    n = inside.groupBy("kind", "entity", "term").agg(F.count(F.lit(1)).alias("n"))
    copies = shared.join(n, ["kind", "entity", "term"]).where(F.col("pairs") > SHARED * (F.col("n") - 1) * F.col("terms"))
    copies = copies.select("kind", "entity", F.col("term").alias("key"), F.lit(True).alias("copied"))
    both = both.join(copies, on, "left")
    return store(both.withColumn("gives_away", F.col("gives_away") & F.col("copied").isNull()).drop("copied"))


def revealing_terms(texts: DataFrame, base: DataFrame) -> DataFrame:
    """(term, replacement): terms that give an entity away, with the class to put in their place, or nothing where that does as well."""
    entity = F.when(F.col("kind") == 0, _lower(F.col("value"))).when(F.col("kind") == 1, F.col("value")).otherwise(F.regexp_replace("value", "[^0-9]", ""))
    near = base.select("kind", entity.alias("entity"), "id", "h", "copies", "left", "right")
    held = near.groupBy("kind", "entity", "id", "h").agg(F.max("copies").alias("copies"))
    held = held.groupBy("kind", "entity").agg(F.sum("copies").alias("df_entity"))
    keys = F.explode(_keys(F.concat_ws(" ", "left", "right"))).alias("key")
    around = near.select("kind", "entity", "id", "h", "copies", F.xxhash64("left", "right").alias("around"), keys)
    # One surrounding for each document, then each surrounding once: copies of a passage are no evidence.
    both = around.groupBy("kind", "entity", "key", "id", "h").agg(F.max("copies").alias("copies"), F.min("around").alias("around"))
    both = both.groupBy("kind", "entity", "key", "around").agg(F.sum("copies").alias("copies"))
    both = both.groupBy("kind", "entity", "key").agg(F.count(F.lit(1)).alias("support"), F.sum("copies").alias("together")).where(F.col("support") >= SUPPORT)
    both = store(both.join(held, ["kind", "entity"]))
    asked = store(both.select("key").distinct())
    empty = both.select(F.col("key").alias("term"), F.col("key").alias("replacement")).limit(0)
    if asked.isEmpty():
        return empty
    counts = _document_frequencies(texts, asked)
    total = texts.count()
    information = F.log2(F.lit(float(total)) / F.col("df_entity"))
    told = F.log2(F.lit(float(total)) * F.col("together") / (F.col("df") * F.col("df_entity")))
    # The sum guards against rounding where a term and its entity always come together.
    gives_away = (information > 0) & (told >= DISCLOSURE * information - 1e-9)
    both = store(both.join(counts, "key").select("kind", "entity", "key", gives_away.alias("gives_away")))
    both = _apart(both, around, ["kind", "entity", "key"])
    is_class = F.col("key").endswith("*")
    classes = both.where(is_class).select("kind", "entity", F.col("key").alias("class"), F.col("gives_away").alias("class_too"))
    terms = both.where(~is_class & F.col("gives_away")).select("kind", "entity", F.col("key").alias("term"), _class(F.col("key")).alias("class"))
    terms = terms.join(classes, ["kind", "entity", "class"]).groupBy("term", "class").agg(F.max("class_too").alias("removed"))
    return store(terms.select("term", F.when(~F.col("removed"), F.col("class")).alias("replacement")))


def _spans(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The texts, and (id, h, kind, start, end, replacement) of all spans."""
    texts = _texts(docs, id_col, text_col)
    base = store(base_spans(texts))
    found = base.select("id", "h", "kind", "start", "end", F.lit(None).cast("string").alias("replacement"))
    revealing = revealing_terms(texts, base)
    if revealing.isEmpty():
        return texts, found
    with_term = texts.select("id", "h", F.explode(F.array_distinct(F.split(_lower(F.col("text")), OUTSIDE, -1))).alias("term"))
    with_term = store(with_term.join(revealing, "term").select(F.col("id").alias("hit"), F.col("h").alias("hit_h")).distinct())
    hit = texts.join(with_term, F.col("id").eqNullSafe(F.col("hit")) & (F.col("h") == F.col("hit_h"))).select("id", "h", "text")
    terms = _pieces(hit, [(BASE, TERM, F.lit(True))]).withColumn("term", _lower(F.col("value"))).join(revealing, "term")
    kind = F.when(F.col("replacement").isNull(), F.lit(BASE + 1)).otherwise(F.lit(BASE))
    return texts, store(found.unionByName(terms.select("id", "h", kind.alias("kind"), "start", "end", "replacement")))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col, n_email, n_ip, n_card, n_phone, base_sha256, spans``.

    ``spans`` lists ``kind:start:end`` (code points, end exclusive) by start, then kind, comma-joined; ``base_sha256`` is the SHA-256 of the
    list of the first four kinds. ``generalised`` and ``removed`` spans are the terms that give an entity away (see above).

    Defined cases: a null text counts as empty; empty texts and texts without personal data have counts of 0, the digest of an empty list and no
    spans. Rows that repeat an id and a text get equal results, each its own row, and count as that many documents; rows that share an id with
    different texts are documents of their own; ids may be of any type, also null. A term near an entity counts once for each different
    surrounding, and surroundings that share most of their terms do not count, so copies and near copies of a passage give nothing away. An empty table gives an empty result; other columns are ignored.
    """
    texts, spans = _spans(docs, id_col, text_col)
    count = lambda k: F.count_if(F.col("kind") == k).alias(f"n_{KINDS[k]}")
    listed = F.sort_array(F.collect_list(F.struct("start", "kind", "end")))
    names = F.array(*[F.lit(k) for k in KINDS])
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
    by_doc = spans.groupBy(F.col("id").alias("of"), F.col("h").alias("of_h")).agg(*[count(k) for k in range(BASE)], listed.alias("listed"))
    rows = texts.select("id", "h").join(by_doc, F.col("id").eqNullSafe(F.col("of")) & (F.col("h") == F.col("of_h")), "left")
    base = F.coalesce(text(F.filter("listed", lambda s: s["kind"] < BASE)), F.lit(""))
    return rows.select(
        F.col("id").alias(id_col),
        *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS[:BASE]],
        F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        F.coalesce(text(F.col("listed")), F.lit("")).alias("spans"),
    )


def sanitised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with personal data replaced: ``[EMAIL]`` and so on for base spans, a term's class for generalised terms, nothing for removed
    ones. Of spans that overlap, the first one's replacement stands for all. A null text stays null; cases as in ``personal_data``."""
    _, spans = _spans(docs, id_col, text_col)
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS[:BASE]])
    spans = spans.withColumn("put", F.coalesce("replacement", F.when(F.col("kind") < BASE, F.get(names, F.col("kind"))), F.lit("")))
    own = Window.partitionBy("id", "h").orderBy("start", "kind")
    reached = F.max("end").over(own.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("opens", F.coalesce((F.col("start") >= reached).cast("int"), F.lit(1)))
    spans = spans.withColumn("run", F.sum("opens").over(own.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    runs = spans.groupBy("id", "h", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("put", F.struct("start", "kind")).alias("put"))
    lists = runs.groupBy(F.col("id").alias("__of"), F.col("h").alias("__of_h")).agg(F.sort_array(F.collect_list(F.struct("start", "end", "put"))).alias("__runs"))
    key = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    rows = docs.join(lists, F.col(id_col).eqNullSafe(F.col("__of")) & (key == F.col("__of_h")), "left")
    rows = rows.withColumn("__letters", F.when(F.col("__runs").isNotNull(), F.split(F.col(text_col).cast("string"), "", -1)))
    before = lambda i: F.when(i > 0, F.get(F.col("__runs"), i - 1)["end"]).otherwise(F.lit(0))
    cut = lambda a, b: F.array_join(F.slice("__letters", (a + 1).cast("int"), (b - a).cast("int")), "")
    parts = F.transform("__runs", lambda r, i: F.concat(cut(before(i), r["start"]), r["put"]))
    last = F.element_at("__runs", -1)["end"]
    tail = cut(last, F.size("__letters").cast("long"))
    text = F.when(F.col("__runs").isNull(), F.col(text_col)).otherwise(F.concat(F.array_join(parts, ""), tail))
    return rows.select(*[text.alias(c) if c == text_col else F.col(c) for c in docs.columns])
