"""Vector codes by product quantisation, trained with anchors-hierarchy metric trees over the parts.

Vectors are cut into equal parts, and each part position has a codebook. Tasks build a tree for each part position over
blocks of vectors, middle-out: anchors are added one by one, each the point farthest from its anchor, and take
the points nearer to them (anchors too far away are not looked at); then the anchors are joined upwards, each time the pair whose ball
is the smallest, and split downwards again in the same way. A ball caches its count and its sum.

A round hands the codebook down each tree. A ball drops the entries that cannot be nearest to any of its points and hands
the others to its children; a ball with one entry left is wholly owned and adds its cached count and sum. Only points of leaves
are compared one by one. Numbers are whole, sums are exact, and an entry is dropped only where it is
farther by more than any rounding, so codes do not depend on blocks, trees or the order of rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churn_engine.llm.common import pieces, ranges, relieve, shared_folder, store

PARTS, ENTRIES, ROUNDS = 8, 16, 6
#: Whole numbers per unit of a component.
SCALE = 4096
#: Vectors of a block, and points of a ball that is not split further.
BLOCK, LEAF = 2048, 48
#: Bytes of a Parquet row group of blocks: what a task holds of them at a time.
GROUP_BYTES = 16 << 20


class Tree:
    """Balls over points in tree order: ball i holds points ``start[i]`` to ``end[i]``; ``left[i]`` < 0 for a leaf."""

    def __init__(self, points: np.ndarray, start: np.ndarray, end: np.ndarray, left: np.ndarray, right: np.ndarray):
        self.points, self.start, self.end, self.left, self.right = points, start, end, left, right
        sums = np.zeros((len(points) + 1, points.shape[1]), np.int64)
        np.cumsum(points, axis=0, out=sums[1:])
        self.count = (end - start).astype(np.int64)
        self.sum = sums[end] - sums[start]
        self.centre = self.sum / self.count[:, None]
        self.radius = np.empty(len(start))
        for i, (a, b) in enumerate(zip(start.tolist(), end.tolist(), strict=True)):
            far = points[a:b] - self.centre[i]
            self.radius[i] = np.einsum("ij,ij->i", far, far).max()
        self.radius = np.sqrt(self.radius) * (1 + 1e-9) + 1e-6


def _anchors(points: np.ndarray, most: int) -> list[np.ndarray]:
    """The points of up to ``most`` anchors, as indices."""
    first = points[0]
    far = np.sqrt(((points - first) ** 2).sum(axis=1))
    order = np.argsort(-far, kind="stable")
    own, dist, pivot = [order], [far[order]], [first]  # points by falling distance from their anchor
    while len(own) < most:
        widest = max(range(len(own)), key=lambda i: dist[i][0])
        if dist[widest][0] == 0:
            break
        new = points[own[widest][0]]
        got, at = [], []
        for i in range(len(own)):
            apart = np.sqrt(((pivot[i] - new) ** 2).sum())
            # A point nearer to its anchor than half of the anchors' distance cannot be nearer to the new one.
            reach = int(np.searchsorted(-dist[i], -(apart / 2), side="left"))
            if not reach:
                continue
            some = own[i][:reach]
            to = np.sqrt(((points[some] - new) ** 2).sum(axis=1))
            taken = to < dist[i][:reach]
            got.append(some[taken])
            at.append(to[taken])
            own[i] = np.concatenate([some[~taken], own[i][reach:]])
            dist[i] = np.concatenate([dist[i][:reach][~taken], dist[i][reach:]])
        mine, far = np.concatenate(got), np.concatenate(at)
        order = np.argsort(-far, kind="stable")
        own.append(mine[order])
        dist.append(far[order])
        pivot.append(new)
    return own


def _joined(groups: list[np.ndarray], points: np.ndarray) -> list[tuple[int, int]]:
    """Which two balls are joined, in order: the pair with the smallest ball around both. A joined ball is the next number."""
    n = len(groups)
    total = 2 * n - 1
    centre, radius, count = np.zeros((total, points.shape[1])), np.zeros(total), np.zeros(total)
    for i, g in enumerate(groups):
        x = points[g]
        centre[i], count[i] = x.mean(axis=0), len(g)
        radius[i] = np.sqrt(((x - centre[i]) ** 2).sum(axis=1).max())
    size = np.full((total, total), np.inf)

    def sizes(i: int, others: np.ndarray) -> None:
        apart = np.sqrt(((centre[others] - centre[i]) ** 2).sum(axis=1))
        around = np.maximum((apart + radius[others] + radius[i]) / 2, np.maximum(radius[others], radius[i]))
        size[i, others] = size[others, i] = around

    alive = np.zeros(total, bool)
    alive[:n] = True
    for i in range(1, n):
        sizes(i, np.arange(i))
    merges = []
    for new in range(n, total):
        a, b = divmod(int(size[:new, :new].argmin()), new)
        merges.append((a, b))
        count[new] = count[a] + count[b]
        centre[new] = (centre[a] * count[a] + centre[b] * count[b]) / count[new]
        to = np.sqrt(((centre[[a, b]] - centre[new]) ** 2).sum(axis=1))
        radius[new] = max(to[0] + radius[a], to[1] + radius[b])
        alive[[a, b]] = False
        size[[a, b], :] = size[:, [a, b]] = np.inf
        others = np.flatnonzero(alive[:new])
        if len(others):
            sizes(new, others)
        alive[new] = True
    return merges


def shape(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order of the points, start, end, left, right) of the balls, the root first."""
    order: list[np.ndarray] = []
    start, end, left, right = [0], [len(points)], [-1], [-1]
    todo = [(0, np.arange(len(points)))]  # balls whose points are known, the rightmost last
    placed = 0
    while todo:
        ball, own = todo.pop()
        groups = _anchors(points[own], max(2, int(np.sqrt(len(own))))) if len(own) > LEAF else [own]
        if len(groups) == 1:  # small, or copies of one point
            order.append(own)
            start[ball], end[ball] = placed, placed + len(own)
            placed += len(own)
            continue
        merges = _joined(groups, points[own])
        n, below = len(groups), []
        stack = [(ball, 2 * n - 2)]
        while stack:  # from the top, left before right
            node, i = stack.pop()
            if i < n:
                below.append((node, own[groups[i]]))
                continue
            kids = []
            for _ in range(2):
                kids.append(len(start))
                for column, value in ((start, 0), (end, 0), (left, -1), (right, -1)):
                    column.append(value)
            left[node], right[node] = kids
            a, b = merges[i - n]
            stack += [(kids[1], b), (kids[0], a)]
        todo += below[::-1]
    start, end, left, right = (np.array(x, np.int32) for x in (start, end, left, right))
    for ball in range(len(start) - 1, -1, -1):  # children have larger numbers
        if left[ball] >= 0:
            start[ball], end[ball] = start[left[ball]], end[right[ball]]
    return np.concatenate(order), start, end, left, right


def squared(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances of all points to all entries."""
    high = max(int(np.abs(points).max(initial=0)), int(np.abs(book).max(initial=0)))
    if 4 * high * high * points.shape[1] < 1 << 52:  # every step is a whole number that a double holds
        x, c = points.astype(np.float64), book.astype(np.float64)
        return ((x * x).sum(axis=1)[:, None] + (c * c).sum(axis=1)[None, :] - 2 * (x @ c.T)).astype(np.int64)
    total = np.zeros((len(points), len(book)), np.int64)
    for j in range(points.shape[1]):
        apart = points[:, j, None].astype(np.int64) - book[None, :, j]
        total += apart * apart
    return total


def owners(tree: Tree, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(balls wholly owned, their entry, other points, their nearest entry); ties go to the lower entry."""
    c = book.astype(np.float64)
    between = np.sqrt(((c[:, None] - c[None]) ** 2).sum(axis=2))
    balls, listed = np.zeros(1, np.int64), np.ones((1, len(book)), bool)
    owned, owner, leaves, leaf_lists = [], [], [], []
    while len(balls):
        m = tree.centre[balls]
        d = ((m[:, None] - c[None]) ** 2).sum(axis=2)
        d[~listed] = np.inf
        best = d.argmin(axis=1)
        nearest = d[np.arange(len(balls)), best][:, None]
        # By how much an entry is farther than the best one, for the point of the ball where that is least.
        lead = d - nearest - 2 * tree.radius[balls][:, None] * between[best]
        with np.errstate(invalid="ignore"):
            listed = listed & ~(lead > 1 + 1e-9 * (np.where(listed, d, 0) + nearest))
        alone = listed.sum(axis=1) == 1
        owned.append(balls[alone])
        owner.append(best[alone])
        leaf = ~alone & (tree.left[balls] < 0)
        leaves.append(balls[leaf])
        leaf_lists.append(listed[leaf])
        rest = ~alone & ~leaf
        balls, listed = np.concatenate([tree.left[balls[rest]], tree.right[balls[rest]]]).astype(np.int64), np.concatenate([listed[rest], listed[rest]])
    balls, listed = np.concatenate(leaves), np.concatenate(leaf_lists)
    at = ranges(tree.start[balls].astype(np.int64), tree.count[balls])
    d = squared(tree.points[at], book)
    d[~np.repeat(listed, tree.count[balls], axis=0)] = np.iinfo(np.int64).max
    return np.concatenate(owned), np.concatenate(owner), at, d.argmin(axis=1)


def _built(width: int, label: pa.DataType):
    """Blocks of vectors with a tree for each part position."""
    size = width // PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        relieve()
        held: list[pa.RecordBatch] = []

        def block() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            x = np.asarray(table["x"].combine_chunks().flatten()).reshape(len(table), width)
            trees = []
            for part in range(PARTS):
                points = x[:, part * size : (part + 1) * size]
                order, start, end, left, right = shape(points)
                balls = np.stack([start, end, left, right]).astype(np.int32)
                trees.append({"points": points[order].tobytes(), "order": order.astype(np.int32).tobytes(), "balls": balls.tobytes()})
            kind = pa.list_(pa.struct([("points", pa.binary()), ("order", pa.binary()), ("balls", pa.binary())]))
            columns = [pa.array([table[c].to_pylist()], pa.list_(t)) for c, t in (("id", pa.int64()), ("label", label))]
            return pa.RecordBatch.from_arrays([*columns, pa.array([trees], kind)], names=["ids", "labels", "trees"])

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                room = BLOCK - sum(b.num_rows for b in held)
                held.append(batch.slice(at, room))
                at += room
                if sum(b.num_rows for b in held) == BLOCK:
                    yield block()
                    held.clear()
        if sum(b.num_rows for b in held):
            yield block()

    return run


def _trees(row: dict, size: int) -> Iterator[tuple[int, Tree, np.ndarray]]:
    for part, tree in enumerate(row["trees"]):
        points = np.frombuffer(tree["points"], np.int64).reshape(-1, size)
        balls = np.frombuffer(tree["balls"], np.int32).reshape(4, -1)
        yield part, Tree(points, *balls), np.frombuffer(tree["order"], np.int32)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _round(books: np.ndarray):
    """Counts (place -1) and sums of the parts that each entry owns, one set for each task."""
    size = books.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(books.shape[:2], np.int64), np.zeros(books.shape, np.int64)
        for row in _rows(batches):
            for part, tree, _ in _trees(row, size):
                balls, owner, at, nearest = owners(tree, books[part])
                np.add.at(count[part], owner, tree.count[balls])
                np.add.at(total[part], owner, tree.sum[balls])
                np.add.at(count[part], nearest, 1)
                np.add.at(total[part], nearest, tree.points[at])
        both = np.concatenate([count[:, :, None], total], axis=2)
        part, entry, place = (x.ravel() for x in np.indices(both.shape))
        yield from pieces({"part": part.astype(np.int32), "entry": entry.astype(np.int32), "place": (place - 1).astype(np.int32), "total": both.ravel()})

    return run


def _coded(books: np.ndarray, label: pa.DataType):
    size = books.shape[2]
    pairs = np.array([f"{i:02x}" for i in range(256)], "S2")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            n = len(row["ids"])
            codes, error = np.zeros((n, PARTS), np.int64), np.zeros(n, np.int64)
            for part, tree, order in _trees(row, size):
                balls, owner, at, nearest = owners(tree, books[part])
                code = np.empty(n, np.int64)
                code[ranges(tree.start[balls].astype(np.int64), tree.count[balls])] = np.repeat(owner, tree.count[balls])
                code[at] = nearest
                apart = tree.points - books[part][code]
                codes[order, part] = code
                error[order] += (apart * apart).sum(axis=1)
            text = pa.array(np.ascontiguousarray(pairs[codes]).view(f"S{2 * PARTS}").ravel().tolist(), pa.binary()).cast(pa.string())
            yield from pieces({"id": pa.array(row["ids"], pa.int64()), "label": pa.array(row["labels"], label), "code": text, "error": error})

    return run


def whole_vectors(rows: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label, x): components as whole numbers; rows without a usable vector are left out (see ``vector_codes``)."""
    x = F.col("v").cast("array<double>")
    limit = F.sqrt(F.lit(float(1 << 61)) / F.size("v"))
    usable = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) * SCALE < limit))
    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v"))
    rows = rows.where(F.col("v").isNotNull() & (F.size("v") > 0)).where(F.coalesce(usable, F.lit(False)))
    return rows.select("id", "label", F.transform(x, lambda c: F.floor(c * SCALE).cast("long")).alias("x"))


def vector_codes(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per usable vector: ``id_col, code, error, label_error, codebooks_sha256``.

    Each codebook starts as the parts of the ``ENTRIES`` smallest ids; ``ROUNDS`` times every part goes to its nearest entry and each
    entry becomes the floor of its parts' mean. Only codebooks and their sums, of fixed size, reach the driver.

    Defined cases: null vectors, empty ones and those with null or non-finite components are left out, also those with components whose
    squared distances a long cannot hold (beyond about 47,000 for 64 components). The first vector by id sets the width, vectors
    of another width are left out; a width that ``PARTS`` does not divide raises ``ValueError``. Ids are whole numbers or null, null ids come last
    among the starting entries and have codes like others. Repeated ids are rows of their own, equal ids start in the order of their components.
    Fewer rows than entries give smaller codebooks; an empty table gives an empty result. Null labels count as equal. Other columns are ignored.
    """
    spark = rows.sparkSession
    whole = whole_vectors(rows, id_col, vector_col, label_col)
    first = whole.orderBy(F.col("id").asc_nulls_last(), "x").limit(1).collect()
    kind = whole.schema["label"].dataType
    if not first:
        empty = T.StructType([T.StructField(id_col, T.LongType()), *[T.StructField(c, T.StringType() if "error" not in c else T.LongType()) for c in ("code", "error", "label_error", "codebooks_sha256")]])
        return spark.createDataFrame([], empty)
    width = len(first[0].x)
    if width % PARTS:
        raise ValueError(f"vectors of {width} components cannot be cut into {PARTS} equal parts")
    whole = whole.where(F.size("x") == width)
    seeds = whole.orderBy(F.col("id").asc_nulls_last(), "x").limit(ENTRIES).collect()
    books = np.array([r.x for r in seeds], np.int64).reshape(len(seeds), PARTS, -1).transpose(1, 0, 2)

    arrow = pa.null() if isinstance(kind, T.NullType) else _arrow(spark, kind)
    sql = kind.simpleString()
    blocks = whole.mapInArrow(_built(width, arrow), f"ids array<long>, labels array<{sql}>, trees array<struct<points: binary, order: binary, balls: binary>>")
    path = shared_folder(spark)
    blocks.write.option("parquet.block.size", GROUP_BYTES).parquet(path)
    blocks = spark.read.schema(blocks.schema).parquet(path)
    for _ in range(ROUNDS):
        sums = blocks.select("trees").mapInArrow(_round(books), "part int, entry int, place int, total long")
        found = np.zeros((*books.shape[:2], books.shape[2] + 1), np.int64)
        for r in sums.groupBy("part", "entry", "place").agg(F.sum("total").alias("total")).collect():
            found[r.part, r.entry, r.place + 1] = r.total
        count = found[:, :, :1]
        books = np.where(count > 0, found[:, :, 1:] // np.maximum(count, 1), books)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    coded = store(blocks.mapInArrow(_coded(books, arrow), f"id long, label {sql}, code string, error long"))
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of")), "left").select(
        F.col("id").alias(id_col), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )


def _arrow(spark, kind: T.DataType) -> pa.DataType:
    """The Arrow type of a column."""
    return spark.createDataFrame([], T.StructType([T.StructField("c", kind)])).toArrow().schema.field("c").type
