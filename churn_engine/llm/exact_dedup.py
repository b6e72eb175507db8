"""Exact dedup by skew-safe combining: local, salted, then global, with whole contents compared each time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churn_engine.llm.common import store, unused

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """A null as an empty text, A-Z as a-z, nothing else changed."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def sha256_of(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16, digest=sha256_of) -> DataFrame:
    """One row per input row: ``id_col, keep_id, group_size, kept, text_sha256``.

    Equal texts form a group; of a group the largest id stays. The grouping key is digest *and* content at every
    stage: Spark's map-side aggregate merges copies within a task, the first exchange merges them per salt, the
    second merges the salts' winners. A group of copies of any size thus reaches a task as at most one row per map
    task, and the global one as at most ``salts`` rows. Rows then find their group by the digest alone, which is
    safe because a digest with more than one content is kept apart and joined on content as well.

    Defined cases: a null text is an empty one; a null id is smaller than all others; rows repeated with the same id
    are all members, and all of those that hold the largest id are kept; an empty table gives an empty result; other
    columns are ignored. ``digest`` is a parameter so that tests can provoke collisions.
    """
    rows = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("body"))
    rows = rows.withColumns({"digest": digest(F.col("body")), "text_sha256": sha256_of(F.col("body"))})
    salt = F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int")
    salted = rows.groupBy("digest", salt.alias("salt"), "body").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    merged = salted.groupBy("digest", "body").agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("n"))
    winners = store(merged.select("digest", "keep_id", F.col("n").alias("group_size")))
    several = store(winners.groupBy("digest").agg(F.count(F.lit(1)).alias("contents")).where("contents > 1").select("digest"))
    if several.limit(1).count():
        contents = merged.withColumnRenamed("n", "group_size").join(several, "digest", "left_semi")
        apart = rows.join(several, "digest", "left_semi").join(contents, ["digest", "body"])
        winners = winners.join(several, "digest", "left_anti")
        found = rows.join(winners, "digest").drop("body").unionByName(apart.drop("body"))
    else:
        found = rows.drop("body").join(winners, "digest")
    return found.select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of rows that repeat id and text, one stays."""
    names = docs.columns
    id_name, sha_name, n_name, own_name = unused(docs, "__id", "__sha", "__n", "__own")
    groups = exact_groups(docs, id_col, text_col).where("kept")
    groups = store(groups.groupBy(F.col(id_col).alias(id_name), F.col("text_sha256").alias(sha_name)).agg(F.count(F.lit(1)).alias(n_name)))
    marked = docs.withColumn(own_name, sha256_of(normalised(F.col(text_col))))
    same = F.col(id_col).eqNullSafe(F.col(id_name)) & (F.col(own_name) == F.col(sha_name))
    once, many = groups.where(F.col(n_name) == 1), groups.where(F.col(n_name) > 1)
    if not many.limit(1).count():
        return marked.join(groups, same, "left_semi").select(*names)
    left = marked.join(once, same, "left_semi").select(*names)
    return left.unionByName(marked.join(many, same, "left_semi").dropDuplicates([id_col, own_name]).select(*names))
