"""Near-duplicate vectors: int8 tile products with per-vector error bounds, then full precision where it matters.

Each unit vector x is stored as scale * q + e with q in whole numbers from -127 to 127. For two of them
|x.y - (s_x s_y) q_x.q_y| <= |e_x| |s_y q_y| + |e_y| (x is a unit vector), so only pairs whose quantised product comes
within that bound of the threshold are computed again in double precision, and none that counts is missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churn_engine.llm.common import components, pieces, small_batches, store

COSINE = 0.98
#: Classes in a tile; a task holds two tiles.
TILE = 1024
#: Added to every error bound for the rounding of the bound itself.
SLACK = 1e-6


def _prepared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Usable vectors as bytes of doubles; others are left out."""
    for batch in batches:
        out: dict[str, list] = {"vec_id": [], "label": [], "vector": []}
        lists = batch.column("embedding")
        for i, (vec_id, label) in enumerate(zip(batch.column("vec_id").to_pylist(), batch.column("label").to_pylist(), strict=True)):
            if not lists[i].is_valid:
                continue
            values = lists[i].values
            if values.null_count or not len(values):
                continue
            x = values.to_numpy(zero_copy_only=False).astype(np.float64)
            if np.isfinite(x).all() and x.any():
                out["vec_id"].append(vec_id)
                out["label"].append(label)
                out["vector"].append(x.tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(out["vec_id"], pa.int64()), pa.array(out["label"], batch.schema.field("label").type), pa.array(out["vector"], pa.binary())],
            names=list(out),
        )


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that no square over- or underflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class Quantised:
    """A tile's unit vectors as int8, with the length of what is lost and of what is kept."""

    def __init__(self, x: np.ndarray):
        self.scale = np.abs(x).max(axis=1, keepdims=True) / 127
        self.q = np.rint(x / self.scale).astype(np.int8)
        kept = self.q * self.scale
        self.lost = np.sqrt(((x - kept) ** 2).sum(axis=1))
        self.kept = np.sqrt((kept**2).sum(axis=1))

    def product(self, other: Quantised) -> tuple[np.ndarray, np.ndarray]:
        """Quantised products of all rows with all rows, and the bound of their error."""
        # Whole numbers below 2**24 are exact in float32 and below 2**53 in double, so the fast product is exact.
        kind = np.float32 if self.q.shape[1] * 127 * 127 < 1 << 24 else np.float64
        products = (self.q.astype(kind) @ other.q.astype(kind).T).astype(np.float64)
        products *= self.scale * other.scale.T
        return products, self.lost[:, None] * other.kept[None, :] + other.lost[None, :] + SLACK


def linked_pairs(x: np.ndarray, y: np.ndarray, cosine: float, upper: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of unit vectors with a cosine of at least ``cosine``; with ``upper`` only i < j."""
    a, b = Quantised(x), Quantised(y)
    found_i, found_j = [], []
    for at in range(0, len(x), 256):
        part = slice(at, at + 256)
        cut = Quantised.__new__(Quantised)
        cut.scale, cut.q, cut.lost, cut.kept = a.scale[part], a.q[part], a.lost[part], a.kept[part]
        products, bound = cut.product(b)
        i, j = np.nonzero(products + bound >= cosine)
        i += at
        if upper:
            i, j = i[i < j], j[i < j]
        for k in range(0, len(i), 1 << 16):  # in double precision
            s = slice(k, k + (1 << 16))
            exact = np.einsum("ij,ij->i", x[i[s]], y[j[s]]) >= cosine
            found_i.append(i[s][exact])
            found_j.append(j[s][exact])
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return join(found_i), join(found_j)


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` nodes the smallest node that the pairs reach."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        after = root.copy()
        np.minimum.at(after, i, low)
        np.minimum.at(after, j, low)
        after = after[after]
        if (after == root).all():
            return root
        root = after


def _tile_links(cosine: float):
    def run(key: tuple, group: pa.Table) -> pa.Table:
        order = np.lexsort((np.asarray(group["vec_id"]), np.asarray(group["tile"])))
        group = group.take(pa.array(order))
        ids, size, tile = (np.asarray(group[c]) for c in ("vec_id", "size", "tile"))
        x = unit(np.frombuffer(b"".join(group["vector"].to_pylist()), np.float64).reshape(len(ids), -1))
        low = int(np.searchsorted(tile, tile[0], side="right"))
        same = key[-2].as_py() == key[-1].as_py()
        if same:
            i, j = linked_pairs(x, x, cosine, True)
        else:
            i, j = linked_pairs(x[:low], x[low:], cosine, False)
            j = j + low
            if tile[0] == tile[-1]:  # only one of the two tiles has rows
                i = j = np.zeros(0, np.int64)
        links = np.bincount(i, size[j], len(ids)) + np.bincount(j, size[i], len(ids))
        # Counts and a spanning forest stand for the pairs: never more rows than the tiles have.
        root = _forest(i, j, len(ids))
        least = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(least, root, ids)
        kept = links > 0
        return pa.table({"vec_id": ids[kept], "links": links[kept].astype(np.int64), "to": least[root][kept]})

    return run


def vector_links(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = COSINE, tile: int = TILE
) -> DataFrame:
    """One row per vector: ``id_col, n_links, component_id, kept``.

    Vectors with equal, non-null labels are linked from ``cosine`` on. Equal vectors of a label form a class first,
    so a vector that occurs millions of times is compared once. Classes are dealt into tiles of about ``tile`` by a
    hash of their id, and each pair of tiles of a label is one group of at most about two tiles, whatever the label's
    size; labels of any size are thus split. A group returns a count per class and a spanning forest, not its pairs.

    The work is that of all pairs of a label's classes in blocks, by fast products: it grows with the square of a
    label, which an exact search with no other structure in the vectors cannot avoid.

    Defined cases: vectors that are null, empty, zero, or hold nulls or numbers that aren't finite, vectors of different
    length, and rows with a null label or id link with nothing; a row that links with nothing is kept; rows that repeat an id
    with equal vectors count as copies of each other and are all kept; an empty table gives an empty result; other columns are ignored.
    """
    small_batches(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"), F.col(label_col).alias("label"))
    usable = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
    kind = usable.schema["label"].dataType.simpleString()
    usable = store(usable.mapInArrow(_prepared, f"vec_id long, label {kind}, vector binary"))
    # -0.0 and 0.0 may keep equal vectors apart; they are linked below then.
    classes = usable.groupBy("label", "vector").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("size"))
    classes = store(classes.withColumn("dims", F.octet_length("vector")))
    tiles = classes.groupBy("label", "dims").agg(F.ceil(F.count(F.lit(1)) / F.lit(tile)).cast("int").alias("tiles"))
    placed = classes.join(tiles, ["label", "dims"]).withColumn("tile", F.pmod(F.xxhash64("vec_id"), "tiles").cast("int"))
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    dealt = dealt.select("label", "dims", F.least("tile", "other").alias("t"), F.greatest("tile", "other").alias("u"), "tile", "vec_id", "size", "vector")
    found = store(dealt.groupBy("label", "dims", "t", "u").applyInArrow(_tile_links(cosine), "vec_id long, links long, to long"))
    counts = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
    reached = components(found, "vec_id", "to")
    whole = (
        classes.select("label", "vector", F.col("vec_id").alias("class"), "size")
        .join(counts.withColumnRenamed("vec_id", "class"), "class", "left")
        .join(reached.withColumnRenamed("node", "class"), "class", "left")
    )
    members = usable.join(whole, ["label", "vector"]).select(
        F.col("vec_id").alias("id"),
        (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
        F.coalesce("component", "class").alias("component"),
    )
    members = members.groupBy("id").agg(F.max("n_links").alias("n_links"), F.min("component").alias("component"))
    return (
        rows.select("vec_id")
        .join(members, F.col("vec_id") == F.col("id"), "left")
        .select(
            F.col("vec_id").alias(id_col),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component", "vec_id").alias("component_id"),
            F.coalesce(F.col("vec_id") == F.col("component"), F.lit(True)).alias("kept"),
        )
    )
