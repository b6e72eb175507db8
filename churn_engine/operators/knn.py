"""Exact k nearest neighbours within one table (Euclidean), without comparing all pairs in one task.

1. Copies of a vector are merged; each distinct vector keeps the ids of its first k + 1 copies, which
   is all that any answer can need.
2. A tree cuts space into leaves, each time across the column in which a bounded sample spreads most. A leaf is cut further into blocks of
   bounded size, so a crowded region is no hot spot. The sample decides how well the search prunes, never what it finds.
3. Every block gets the smallest box around its vectors, every node of the tree the box around its blocks. In its own block each vector
   finds k candidates and so an upper bound of its k-th distance.
4. The distance to a box is a lower bound of the distance to all vectors in it, in all columns at once. Each vector goes down the tree
   and lists the blocks that its bound reaches. It visits the nearest of them first, which tightens the bound, then those still in
   reach. Visitors of one block are split into groups of bounded size, so each task holds two small matrices.
5. The answers of the visited blocks are merged, and copies put back.

The work depends on how well boxes separate the data; the answer does not.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from math import ceil

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churn_engine.session import materialise

#: Vectors on the driver that shape the tree, and its leaves; where there are more blocks than leaves, a leaf holds several.
SAMPLE, LEAVES = 1 << 16, 4096

# Executors need not have this package: the task functions travel with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FOUND = "vid string, neighbour string, d2 double"


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All squared distances between two small sets, summed column by column in order."""
    total = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        diff = a[:, j, None] - b[None, :, j]
        total += diff * diff
    return total


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=float)


def _search(k: int):
    """The k nearest (distance, id) of the visitors among the vectors of one block."""

    def search(visitors: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if visitors.empty or block.empty:
            return pd.DataFrame({"vid": [], "neighbour": [], "d2": []}).astype({"vid": str, "neighbour": str, "d2": float})
        copies = block["ids"].map(len).to_numpy()
        owner = np.repeat(np.arange(len(block)), copies)
        ids = np.concatenate(block["ids"].tolist())
        by_id = np.argsort(ids, kind="stable")
        owner, ids = owner[by_id], ids[by_id]
        d2 = squared_distances(_matrix(visitors["x"]), _matrix(block["host_x"]))
        d2[visitors["vid"].to_numpy()[:, None] == block["host"].to_numpy()[None, :]] = np.inf
        spread = d2[:, owner]
        nearest = np.argsort(spread, axis=1, kind="stable")[:, :k]
        values = np.take_along_axis(spread, nearest, axis=1)
        out = pd.DataFrame(
            {
                "vid": np.repeat(visitors["vid"].to_numpy(), nearest.shape[1]),
                "neighbour": ids[nearest].ravel(),
                "d2": values.ravel(),
            }
        )
        return out[np.isfinite(out["d2"])]

    return search


class Tree:
    """Cuts of space: node i goes left (2i + 1) where ``x[column[i]] < cut[i]``, else right (2i + 2); a leaf has column -1."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.column, self.cut, self.leaf, self.axis = {}, {}, {}, []
        todo = [(0, np.arange(len(sample)), max(1, leaves))]
        while todo:
            node, own, share = todo.pop(0)
            spread = sample[own].max(axis=0) - sample[own].min(axis=0) if len(own) else np.zeros(sample.shape[1])
            widest = int(spread.argmax())
            if share == 1 or len(own) < 2 or not spread[widest]:
                self.column[node], self.leaf[node] = -1, len(self.axis)
                self.axis.append(widest)
                continue
            values = np.sort(sample[own, widest])
            cut = values[len(values) * (share // 2) // share]
            cut = cut if cut > values[0] else values[np.searchsorted(values, cut, side="right")]
            self.column[node], self.cut[node] = widest, cut
            low = sample[own, widest] < cut
            todo += [(2 * node + 1, own[low], share // 2), (2 * node + 2, own[~low], share - share // 2)]

    def route(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector."""
        out = np.zeros(len(x), np.int32)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, own = todo.pop()
            if self.column[node] < 0:
                out[own] = self.leaf[node]
                continue
            low = x[own, self.column[node]] < self.cut[node]
            todo += [(2 * node + 1, own[low]), (2 * node + 2, own[~low])]
        return out

    def with_boxes(self, low: np.ndarray, high: np.ndarray) -> Tree:
        """Boxes of all nodes from those of the leaves (infinitely small where a leaf is empty)."""
        self.low, self.high = {}, {}
        for node in sorted(self.column, reverse=True):
            if self.column[node] < 0:
                self.low[node], self.high[node] = low[self.leaf[node]], high[self.leaf[node]]
            else:
                kids = 2 * node + 1, 2 * node + 2
                self.low[node], self.high[node] = np.minimum(*(self.low[i] for i in kids)), np.maximum(*(self.high[i] for i in kids))
        return self

    def within(self, x: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(vector, leaf) of all leaves whose box a vector's radius reaches."""
        found, todo = [(np.zeros(0, np.int64), np.zeros(0, np.int32))], [(0, np.arange(len(x)))]
        while todo:
            node, own = todo.pop()
            away = np.maximum(0.0, np.maximum(self.low[node] - x[own], x[own] - self.high[node]))
            own = own[np.sqrt((away * away).sum(axis=1)) <= radius[own]]
            if not len(own):
                continue
            if self.column[node] < 0:
                found.append((own, np.full(len(own), self.leaf[node], np.int32)))
            else:
                todo += [(2 * node + 1, own), (2 * node + 2, own)]
        return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _routed(tree: Tree):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            leaf = tree.route(_matrix(rows["x"])) if len(rows) else np.zeros(0, np.int32)
            axis = np.array(tree.axis)[leaf]
            along = [v[j] for v, j in zip(rows["x"], axis, strict=True)]
            yield pd.DataFrame({"vid": rows["vid"], "ids": rows["ids"], "x": rows["x"], "leaf": leaf, "along": along})

    return run


def _reached(tree: Tree):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if len(rows):
                i, leaf = tree.within(_matrix(rows["x"]), rows["radius"].to_numpy())
                part = rows.iloc[i]
                yield pd.DataFrame({"vid": part["vid"], "x": part["x"], "home": part["home"], "home_part": part["home_part"], "radius": part["radius"], "leaf": leaf})

    return run


def _own(k: int):
    """The k nearest of each vector within its own block."""
    search = _search(k)

    def run(block: pd.DataFrame) -> pd.DataFrame:
        return search(block, block.rename(columns={"vid": "host", "x": "host_x"}))

    return run


def _visited(visits: DataFrame, blocks: DataFrame, k: int, block: int) -> DataFrame:
    """What the visitors (vid, x, leaf, part) find; a block's visitors in groups of bounded size."""
    crowds = visits.groupBy("leaf", "part").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(block))).cast("int").alias("groups"))
    seat = F.pmod(F.xxhash64("vid", F.lit(7)), F.col("groups")).cast("int")
    visitors = visits.join(crowds, ["leaf", "part"]).select("leaf", "part", seat.alias("seat"), "vid", "x")
    hosts = blocks.join(crowds, ["leaf", "part"]).select(
        F.col("leaf").alias("host_leaf"),
        F.col("part").alias("host_part"),
        F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("host_seat"),
        F.col("vid").alias("host"),
        "ids",
        F.col("x").alias("host_x"),
    )
    return visitors.groupBy("leaf", "part", "seat").cogroup(hosts.groupBy("host_leaf", "host_part", "host_seat")).applyInPandas(_search(k), FOUND)


def _closest(found: DataFrame, k: int) -> DataFrame:
    closest = Window.partitionBy("vid").orderBy("d2", "neighbour")
    return found.withColumn("_r", F.row_number().over(closest)).where(F.col("_r") <= k).drop("_r")


def _radius(found: DataFrame, k: int) -> DataFrame:
    """(vid, radius): the k-th distance found, with slack for rounding; a vector with fewer has no row."""
    kth = found.groupBy("vid").agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.max("d2")).alias("d"))
    return kth.where(F.col("n") >= k).select("vid", (F.col("d") * (1 + 1e-9) + 1e-12).alias("radius"))


def _merged(points: DataFrame, features: Sequence[str], id_col: str, k: int) -> tuple[DataFrame, DataFrame]:
    """(id, x) of all points; distinct vectors with the ids of their first k + 1 copies."""
    x = F.array(*[F.col(c).cast("double") + F.lit(0.0) for c in features])
    members = points.select(F.col(id_col).alias("id"), x.alias("x"))
    # The rank filter is applied before and after the shuffle (group limit).
    copies = Window.partitionBy("x").orderBy("id")
    heads = members.withColumn("_copy", F.row_number().over(copies)).where(F.col("_copy") <= k + 1)
    return members, heads.groupBy("x").agg(F.array_sort(F.collect_list("id")).alias("ids")).withColumn("vid", F.col("ids")[0])


def _blocks(vectors: DataFrame, count: int, width: int, block: int) -> tuple[Tree, DataFrame]:
    """The tree, and the vectors with their block (leaf, part)."""
    share = min(1.0, SAMPLE / max(count, 1))
    drawn = vectors.where(F.pmod(F.xxhash64("vid", F.lit(3)), F.lit(1 << 30)) < int(share * (1 << 30))).select("x").limit(2 * SAMPLE)
    drawn = drawn if count > block else drawn.limit(0)
    sample = np.array([r.x for r in drawn.collect()], dtype=float).reshape(-1, width)
    tree = Tree(sample, min(ceil(count / block), LEAVES))
    routed = vectors.select("vid", "ids", "x").mapInPandas(_routed(tree), "vid string, ids array<string>, x array<double>, leaf int, along double")
    if len(tree.axis) == 1 and count <= block:
        return tree, routed.withColumn("part", F.lit(0)).drop("along")
    place = F.row_number().over(Window.partitionBy("leaf").orderBy("along", "vid")) - 1
    return tree, routed.withColumn("part", F.floor(place / F.lit(block)).cast("int")).drop("along")


def _visits(blocks: DataFrame, tree: Tree, found: DataFrame, width: int, k: int) -> DataFrame:
    """(vid, x, leaf, part, away): blocks other than its own that a vector's bound reaches, with the distance to their boxes."""
    dims = range(width)
    ends = [F.array(*[f(F.col("x")[j]) for j in dims]) for f in (F.min, F.max)]
    boxes = materialise(blocks.groupBy("leaf", "part").agg(ends[0].alias("low"), ends[1].alias("high")))
    around = boxes.groupBy("leaf").agg(F.array(*[F.min(F.col("low")[j]) for j in dims]).alias("low"), F.array(*[F.max(F.col("high")[j]) for j in dims]).alias("high"))
    low, high = np.full((len(tree.axis), width), np.inf), np.full((len(tree.axis), width), -np.inf)
    for r in around.collect():  # at most LEAVES boxes
        low[r.leaf], high[r.leaf] = r.low, r.high
    tree.with_boxes(low, high)
    # A vector with more than k copies is answered by them alone.
    asking = blocks.where(F.size("ids") <= k).select("vid", "x", F.col("leaf").alias("home"), F.col("part").alias("home_part"))
    asking = asking.join(_radius(found, k), "vid", "left").withColumn("radius", F.coalesce("radius", F.lit(float("inf"))))
    reached = asking.mapInPandas(_reached(tree), "vid string, x array<double>, home int, home_part int, radius double, leaf int")
    near = reached.join(boxes, "leaf").where((F.col("leaf") != F.col("home")) | (F.col("part") != F.col("home_part")))
    outside = F.zip_with("x", F.zip_with("low", "high", lambda a, b: F.struct(a.alias("a"), b.alias("b"))), lambda v, e: F.greatest(F.lit(0.0), e["a"] - v, v - e["b"]))
    away = F.sqrt(F.aggregate(outside, F.lit(0.0), lambda total, d: total + d * d))
    return near.withColumn("away", away).where(F.col("away") <= F.col("radius")).select("vid", "x", "leaf", "part", "away", "radius")


def _all_found(vectors: DataFrame, width: int, k: int, block: int) -> tuple[DataFrame, int, DataFrame | None]:
    """(candidates of all distinct vectors, number of blocks, visits to blocks other than one's own)."""
    count = vectors.count()
    tree, blocks = _blocks(vectors, count, width, block)
    blocks = materialise(blocks)
    found = blocks.groupBy("leaf", "part").applyInPandas(_own(k), FOUND)
    if count <= block:
        return found, 1, None
    found = materialise(found)
    visits = materialise(_visits(blocks, tree, found, width, k))
    order = F.row_number().over(Window.partitionBy("vid").orderBy("away", "leaf", "part"))
    visits = visits.withColumn("turn", order)
    first = _visited(visits.where("turn = 1").select("vid", "x", "leaf", "part"), blocks, k, block)
    found = materialise(_closest(found.unionByName(first), k))
    tight = _radius(found, k).withColumnRenamed("radius", "tighter")
    rest = visits.where("turn > 1").join(tight, "vid", "left").where(F.col("away") <= F.coalesce("tighter", "radius"))
    rest = materialise(rest.select("vid", "x", "leaf", "part"))
    done = visits.where("turn = 1").select("vid", "leaf", "part").unionByName(rest.select("vid", "leaf", "part"))
    return _closest(found.unionByName(_visited(rest, blocks, k, block)), k), blocks.select("leaf", "part").distinct().count(), done


def visited_blocks(points: DataFrame, features: Sequence[str], id_col: str = "id", k: int = 5, block: int = 1024) -> dict[str, int]:
    """How much a search has to look at: distinct vectors, blocks, and visits to blocks other than a vector's own."""
    vectors = materialise(_merged(points, features, id_col, k)[1])
    _, blocks, visits = _all_found(vectors, len(features), k, block)
    return {"vectors": vectors.count(), "blocks": blocks, "visits": visits.count() if visits is not None else 0}


def nearest_neighbours(
    points: DataFrame, features: Sequence[str], id_col: str = "id", k: int = 5, block: int = 1024
) -> DataFrame:
    """(id, neighbour, rank 1..k, distance); equal distances are ranked by neighbour id.

    ``points`` has a unique string ``id_col`` and numeric, non-null ``features``. It is read more than
    once: pass a checkpointed or stored table when it is costly.
    """
    members, vectors = _merged(points, features, id_col, k)
    vectors = materialise(vectors)
    found, _, _ = _all_found(vectors, len(features), k, block)
    # Every member gets its list: its own copies first, itself left out.
    others = found.groupBy("vid").agg(F.collect_list(F.struct("d2", F.col("neighbour").alias("id"))).alias("far"))
    own = F.transform("ids", lambda i: F.struct(F.lit(0.0).alias("d2"), i.alias("id")))
    empty = F.filter(own, lambda c: F.lit(False))
    lists = vectors.join(others, "vid", "left").select(
        "x", F.array_sort(F.concat(own, F.coalesce(F.col("far"), empty))).alias("near")
    )
    ranked = members.join(lists, "x").select(
        "id", F.posexplode(F.slice(F.filter("near", lambda c: c["id"] != F.col("id")), 1, k)).alias("_pos", "_c")
    )
    return ranked.select(
        F.col("id").alias(id_col),
        F.col("_c")["id"].alias("neighbour"),
        (F.col("_pos") + 1).alias("rank"),
        F.sqrt(F.col("_c")["d2"]).alias("distance"),
    )
