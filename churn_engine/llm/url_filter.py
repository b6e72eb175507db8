"""URL rules and lists: a blocked Bloom filter of listed canonical URLs, then an exact join of what passes it.

Built-in functions only. A listed entry is a host and the beginning of a path. The keys under which a URL could be listed
are its host and the parents of its host, each with the beginnings of its path of the lengths that are listed. The
filter grows with the list, 16 bits for each key, and lets through the keys that may be listed; the join decides.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys for each 64-bit block of the filter, and bits set per key: about one unlisted key in a hundred passes.
KEYS, BITS = 4, 4
#: A filter of more blocks than this (4 million keys) is not broadcast; Spark then joins it like any table.
BROADCAST_BLOCKS = 1 << 20

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def canonical(url: Column) -> tuple[Column, Column]:
    """(host, path): the host after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; the path up to ``?``,
    ``#`` or the end. Both are empty for a null or a text without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(1)), F.lit(blocks)).cast("int")


def _mask(key: Column) -> Column:
    """The bits of a key in its block, six bits of a hash for each."""
    bits = F.xxhash64(key, F.lit(2))
    shift = lambda i: F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int")
    one = lambda n: F.call_function("shiftleft", F.lit(1).cast("long"), n)
    return reduce(lambda a, b: a.bitwiseOR(b), [one(shift(i)) for i in range(BITS)])


def blocked_filter(keys: DataFrame, n_keys: int, key: str = "key") -> tuple[DataFrame, int]:
    """The filter as rows ``block, bits`` (blocks without keys have none), and its number of blocks."""
    blocks = -(-max(n_keys, 1) // KEYS)
    return keys.groupBy(_block(F.col(key), blocks).alias("block")).agg(F.bit_or(_mask(F.col(key))).alias("bits")), blocks


def passed(rows: DataFrame, keys: DataFrame, n_keys: int, key: str = "key") -> DataFrame:
    """The rows whose ``key`` may be among ``keys``; none that is among them is left out."""
    held, blocks = blocked_filter(keys, n_keys)
    held = F.broadcast(held) if blocks <= BROADCAST_BLOCKS else held
    near = rows.withColumn("block", _block(F.col(key), blocks)).join(held, "block")
    return near.where(F.col("bits").bitwiseAND(_mask(F.col(key))) == _mask(F.col(key))).drop("block", "bits")


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """One row per input row: ``id_col, host, path, rule, verdict``.

    ``rules`` has ``host, path, verdict``. A rule fits its host and all subdomains if the path starts with the rule's; the
    longest rule (host and path together, then the longer host, then the verdict that sorts first, block after allow) wins. A URL that
    is not listed gets ``default`` and a null ``rule``. Each distinct host and path is judged once; rows find their verdict by a join that
    Spark can split where a host holds a third of all rows.

    Defined cases: null urls and texts without ``://`` have an empty host and path and fit no rule; null ids and repeated rows are judged like
    any other; an empty table gives an empty result, empty rules the default; other columns are ignored. Rules with a null or empty host or
    a null path are ignored; a host is compared without regard to A-Z.
    """
    host, path = canonical(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    listed = rules.select(F.translate("host", UPPER, LOWER).alias("rule_host"), F.col("path").alias("rule_path"), "verdict")
    listed = listed.where("rule_host != '' AND rule_path IS NOT NULL AND verdict IS NOT NULL")
    key = F.concat_ws("\n", "rule_host", "rule_path")
    listed = listed.groupBy("rule_host", "rule_path").agg(F.min("verdict").alias("verdict")).withColumn("key", key)
    # Shapes of the list: how many entries and labels of hosts it has, and which lengths its paths.
    shape = listed.agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.size(F.split("rule_host", r"\."))).alias("labels"),
        F.sort_array(F.collect_set(F.length("rule_path"))).alias("lengths"),
    ).collect()[0]
    labels, lengths = shape.labels or 0, list(shape.lengths or [])
    urls = rows.where("host != ''").select("host", "path").distinct()
    parts = F.split("host", r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.least(F.size(parts), F.lit(max(1, labels)))), lambda n: F.array_join(F.slice(parts, -n, n), "."))
    beginnings = F.transform(
        F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("path")), lambda n: F.substring("path", F.lit(1), n)
    )
    keys = F.flatten(F.transform(parents, lambda h: F.transform(beginnings, lambda p: F.concat_ws("\n", h, p))))
    possible = passed(urls.select("host", "path", F.explode(keys).alias("key")), listed, shape.n)
    exact = possible.join(listed, "key")
    size = F.struct(F.length("rule_host") + F.length("rule_path"), F.length("rule_host"), "rule_host", "rule_path")
    best = exact.groupBy("host", "path").agg(F.max_by(F.struct("rule_host", "rule_path", "verdict"), size).alias("r"))
    best = best.select("host", "path", F.concat("r.rule_host", "r.rule_path").alias("rule"), F.col("r.verdict").alias("told"))
    return rows.join(best, ["host", "path"], "left").select(
        F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("told", F.lit(default)).alias("verdict")
    )
