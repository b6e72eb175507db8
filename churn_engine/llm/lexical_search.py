"""Ranked lexical search by a K2-treap over the grid of terms and documents.

Every task lays a grid over a few thousand documents at a time: a row for each term that the items ask for, a column for each
document, at a crossing the impact of the term in the document. The grid is cut in four again and again; a cell knows which of its
quarters hold anything and the greatest impact in it, and its filled quarters lie side by side on the level below, so a cell is
four bits, the place of its first quarter and a maximum.

An item owns one path for each of its terms. All paths go down together: a state is an item, a range of documents and, for each term
found there, the cell of the term's row; its bound is the sum of weights times maxima. The states with the highest
bounds are halved first, a state of one document is an exact score, and what cannot reach the item's ``k``-th score so far is
dropped. That score carries over from grid to grid within a task; equal bounds go on, since equal scores go by document id.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churn_engine.llm.common import in_slices, pieces, ranges, relieve, small_batches, store, text_bytes
from churn_engine.llm.words import FOLDED, span_hashes, word_spans

TOP = 20
#: Items whose terms travel to the tasks at a time.
ITEMS = 1024
#: Documents and points of a grid; items that go down a grid together, and states of each that are halved at a time.
COLUMNS, POINTS = 4096, 1 << 20
TOGETHER, AHEAD = 32, 32
#: Entries of states that are kept before those of finished states are dropped.
POOL = 1 << 21

#: Bytes outside of terms. 00-2F, 3A-40, 5B-60, 7B-7F.
OUTSIDE = np.zeros(256, bool)
for _a, _b in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    OUTSIDE[_a : _b + 1] = True

_BITS = (np.arange(16)[:, None] >> np.arange(4)) & 1
#: How many quarters before quarter q a cell with these four bits holds.
BEFORE = np.cumsum(_BITS, axis=1) - _BITS


def terms_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms of all texts, and for each text the index of its first (one more than texts)."""
    data, offsets = text_bytes(column)
    starts, ends, first = word_spans(data, offsets, OUTSIDE)
    return span_hashes(data, starts, ends, FOLDED), first


def _spread(x: np.ndarray) -> np.ndarray:
    """The low 31 bits of each number with a zero between them."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


class Grid:
    """Cells of all levels one after the other: bits of filled quarters, place of the first, greatest impact."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray):
        self.depth = max(1, int(max(rows.max(), columns.max())).bit_length())
        codes = (_spread(rows) << np.uint64(1)) | _spread(columns)
        order = np.argsort(codes, kind="stable")
        codes, best = codes[order], impacts[order]
        levels = [(np.zeros(len(codes), np.uint8), np.zeros(len(codes), np.int64), best)]
        for _ in range(self.depth):
            quarter = np.left_shift(1, (codes & np.uint64(3)).astype(np.uint8)).astype(np.uint8)
            codes = codes >> np.uint64(2)
            first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
            best = np.maximum.reduceat(best, first)
            levels.append((np.bitwise_or.reduceat(quarter, first), first, best))
            codes = codes[first]
        levels.reverse()
        place = np.cumsum([0, *(len(x[0]) for x in levels)])
        self.filled = np.concatenate([x[0] for x in levels])
        self.first = np.concatenate([x[1] + place[i + 1] for i, x in enumerate(levels)])
        self.best = np.concatenate([x[2] for x in levels])


class Best:
    """The ``k`` best documents of each item so far."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.zeros(items, np.int64)
        self.item, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.null = np.zeros(0, bool)

    def add(self, item: np.ndarray, score: np.ndarray, null: np.ndarray, ids: np.ndarray) -> None:
        old = np.isin(self.item, item)
        item, score = np.concatenate([self.item[old], item]), np.concatenate([self.score[old], score])
        null, ids = np.concatenate([self.null[old], null]), np.concatenate([self.id[old], ids])
        order = np.lexsort((ids, null, -score, item))
        item, score, null, ids = item[order], score[order], null[order], ids[order]
        rank = _rank(item)
        full = rank == self.k - 1
        self.least[item[full]] = score[full]
        top = rank < self.k
        self.item, self.score = np.concatenate([self.item[~old], item[top]]), np.concatenate([self.score[~old], score[top]])
        self.null, self.id = np.concatenate([self.null[~old], null[top]]), np.concatenate([self.id[~old], ids[top]])


def _rank(sorted_keys: np.ndarray) -> np.ndarray:
    """The place of each row within its run of equal keys."""
    at = np.arange(len(sorted_keys))
    first = np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]) if len(at) else np.zeros(0, bool)
    return at - np.maximum.accumulate(np.where(first, at, 0)) if len(at) else at


def descend(grid: Grid, first: np.ndarray, rows: np.ndarray, weights: np.ndarray, items: np.ndarray, best: Best, ids: np.ndarray, null: np.ndarray) -> None:
    """Bring the best documents of a grid into ``best``. Item i asks for ``rows[first[i]:first[i + 1]]``."""
    length = first[items + 1] - first[items]
    asked = ranges(first[items], length)
    # Entries: row, weight, cell. States: item, level, range of documents, bound, and their entries.
    row, weight, cell = rows[asked], weights[asked], np.zeros(len(asked), np.int64)
    held = length > 0
    item, start, length = items[held], (np.cumsum(length) - length)[held], length[held]
    level, column = np.zeros(len(item), np.int64), np.zeros(len(item), np.int64)
    bound = np.full(len(item), np.iinfo(np.int64).max)
    while len(item):
        order = np.lexsort((-bound, item))
        ahead = _rank(item[order]) < AHEAD
        chosen, rest = order[ahead], order[~ahead]
        entries = ranges(start[chosen], length[chosen])
        state = np.repeat(np.arange(len(chosen)), length[chosen])
        below = level[chosen] + 1
        bit = (row[entries] >> (grid.depth - below)[state]) & 1
        at = cell[entries]
        filled, child = grid.filled[at], grid.first[at]
        parts = []
        for half in (0, 1):
            quarter = 2 * bit + half
            there = np.flatnonzero((filled >> quarter.astype(np.uint8)) & 1)
            parts.append((entries[there], child[there] + BEFORE[filled[there], quarter[there]], state[there]))
        new_row = np.concatenate([row[e] for e, _, _ in parts])
        new_weight = np.concatenate([weight[e] for e, _, _ in parts])
        new_cell = np.concatenate([c for _, c, _ in parts])
        counts = np.concatenate([np.bincount(s, minlength=len(chosen)) for _, _, s in parts])
        ends = np.cumsum(counts)
        sums = np.concatenate([[0], np.cumsum(new_weight * grid.best[new_cell])])
        new_bound = sums[ends] - sums[ends - counts]
        new_item, new_level = np.tile(item[chosen], 2), np.tile(below, 2)
        new_column = np.concatenate([2 * column[chosen], 2 * column[chosen] + 1])
        new_start = len(row) + ends - counts
        done = (new_level == grid.depth) & (new_bound > 0) & (new_bound >= best.least[new_item])
        if done.any():
            where = new_column[done]
            best.add(new_item[done], new_bound[done], null[where], ids[where])
        open_ = (new_level < grid.depth) & (new_bound > 0)
        row, weight, cell = np.concatenate([row, new_row]), np.concatenate([weight, new_weight]), np.concatenate([cell, new_cell])
        item, level, column = (np.concatenate([a[rest], b[open_]]) for a, b in ((item, new_item), (level, new_level), (column, new_column)))
        bound, start, length = (np.concatenate([a[rest], b[open_]]) for a, b in ((bound, new_bound), (start, new_start), (length, counts)))
        alive = bound >= best.least[item]
        item, level, column, bound, start, length = (x[alive] for x in (item, level, column, bound, start, length))
        if len(row) > POOL:
            entries = ranges(start, length)
            row, weight, cell = row[entries], weight[entries], cell[entries]
            start = np.cumsum(length) - length


def _postings(batch: pa.RecordBatch, text_col: str, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(terms of each document; and for each asked term in a document: document, place of the term in ``asked``, occurrences)."""
    hashes, first = terms_of(batch.column(text_col))
    place = np.searchsorted(asked, hashes)
    place[place == len(asked)] = 0
    hit = np.flatnonzero(asked[place] == hashes) if len(asked) else np.zeros(0, np.int64)
    document = np.searchsorted(first, hit, side="right") - 1
    pairs, tf = np.unique(document * max(1, len(asked)) + place[hit], return_counts=True)
    return np.diff(first), pairs // max(1, len(asked)), pairs % max(1, len(asked)), tf.astype(np.int64)


def _statistics(text_col: str, asked: np.ndarray):
    """(place of a term, documents that hold it), and for places -1 and -2 the documents with terms and all terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, documents, terms = np.zeros(len(asked), np.int64), 0, 0
        for batch in in_slices(batches, text_col):
            n, _, place, _ = _postings(batch, text_col, asked)
            held += np.bincount(place, minlength=len(asked))
            documents, terms = documents + int((n > 0).sum()), terms + int(n.sum())
        some = np.flatnonzero(held)
        yield from pieces({"place": np.concatenate([some, [-1, -2]]), "total": np.concatenate([held[some], [documents, terms]])})

    return run


def _ranked(id_col: str, text_col: str, asked: np.ndarray, first: np.ndarray, rows: np.ndarray, weights: np.ndarray, mean: tuple[int, int], k: int):
    """Each task's ``k`` best documents of each item."""
    documents, terms = mean

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(first) - 1, k)
        held: list[tuple[np.ndarray, ...]] = []

        def search() -> None:
            ids, null, column, row, impact = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            if len(row):
                grid = Grid(row, column, impact)
                for at in range(0, len(first) - 1, TOGETHER):
                    descend(grid, first, rows, weights, np.arange(at, min(at + TOGETHER, len(first) - 1)), best, ids, null)

        columns = points = 0
        for batch in in_slices(batches, text_col):
            for at in range(0, batch.num_rows, COLUMNS):
                part = batch.slice(at, COLUMNS)
                n, document, row, tf = _postings(part, text_col, asked)
                m = 100 - 25 + (25 * n.astype(np.int64) * documents) // terms
                impact = (1_000_000_000 * tf) // (1000 * tf + 12 * m[document])
                if columns and (columns + part.num_rows > COLUMNS or points + len(row) > POINTS):
                    search()
                    columns = points = 0
                ids = part.column(id_col)
                held.append((np.asarray(ids.fill_null(0)).astype(np.int64), np.asarray(ids.is_null()), document + columns, row, impact))
                columns, points = columns + part.num_rows, points + len(row)
        if held:
            search()
        relieve()
        yield from pieces({"place": best.item, "doc": pa.array(best.id, pa.int64(), mask=best.null), "score": best.score})

    return run


def ranked_search(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", query_col: str = "text", k: int = TOP
) -> DataFrame:
    """The ``k`` documents with the highest scores above 0 for each item: ``item_col, rank, id_col, score``.

    Terms are runs of digits, letters and characters beyond ASCII, A-Z lower-cased, known by 64-bit hashes (that some
    other term of the documents is taken for one of a thousand asked ones has a probability below 1 in 10 million at a billion
    distinct terms). All documents are read twice for each ``ITEMS`` items: for the counts, then for the ranking. What reaches the driver
    is the items of one block and a count for each of their terms; a task hands on ``k`` rows for each item.

    Defined cases: null and empty texts have no terms; an item without terms, or whose terms no document holds, has no rows. Document ids are
    whole numbers or null; equal scores go by ascending id, null ids last. Rows that repeat an id are documents of their own. Equal item
    rows count once; rows that share an item id with different texts are ranked each by itself. Empty tables give an empty result; other
    columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col(id_col).cast("long").alias(id_col), text_col)
    asked_for = items.select(F.col(item_col).alias("item"), F.col(query_col).alias("query")).where("query IS NOT NULL").distinct()
    asked_for = store(asked_for.withColumn("part", F.xxhash64("item", "query")))
    blocks = ceil(asked_for.count() / ITEMS)
    found = []
    for block in range(blocks):
        rows = asked_for.where(F.pmod("part", F.lit(blocks)) == block).drop("part").collect()
        result = _search_block(docs, id_col, text_col, [r.query for r in rows], k)
        if result is not None:
            names = spark.createDataFrame([(i, r.item) for i, r in enumerate(rows)], f"place long, item {items.schema[item_col].dataType.simpleString()}")
            found.append(result.join(names, "place").withColumn("block", F.lit(block)))
    kind = items.schema[item_col].dataType.simpleString()
    if not found:
        return spark.createDataFrame([], f"`{item_col}` {kind}, rank int, `{id_col}` long, score long")
    every = found[0]
    for other in found[1:]:
        every = every.unionByName(other)
    # Best of some tasks first, so that no group holds the rows of all of them.
    order = [F.col("score").desc(), F.col("doc").asc_nulls_last()]
    some = Window.partitionBy("block", "place", F.pmod(F.xxhash64("doc"), F.lit(64))).orderBy(*order)
    whole = Window.partitionBy("block", "place").orderBy(*order)
    every = every.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= k)
    every = every.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k)
    return every.select(F.col("item").alias(item_col), "rank", F.col("doc").alias(id_col), "score")


def _search_block(docs: DataFrame, id_col: str, text_col: str, queries: list[str], k: int) -> DataFrame | None:
    """(place of the item, doc, score): the best of each task."""
    hashes, first = terms_of(pa.array(queries, pa.string()))
    asked = np.unique(hashes)
    if not len(asked):
        return None
    counts = docs.select(text_col).mapInArrow(_statistics(text_col, asked), "place long, total long").groupBy("place").agg(F.sum("total").alias("total"))
    totals = {r.place: r.total for r in counts.collect()}
    documents, terms = totals.get(-1, 0), totals.get(-2, 0)
    if not documents:
        return None
    weight = np.array([floor(1000 * log((2 * documents + 2) / (2 * totals.get(i, 0) + 1))) for i in range(len(asked))], np.int64)
    # One path for each distinct term of an item, its weight times its repeats.
    item = np.repeat(np.arange(len(queries)), np.diff(first))
    pairs, repeats = np.unique(item * len(asked) + np.searchsorted(asked, hashes), return_counts=True)
    item, rows = pairs // len(asked), pairs % len(asked)
    told = weight[rows] > 0
    item, rows, weights = item[told], rows[told], (weight[rows] * repeats)[told]
    starts = np.searchsorted(item, np.arange(len(queries) + 1))
    run = _ranked(id_col, text_col, asked, starts, rows, weights, (documents, terms), k)
    return store(docs.mapInArrow(run, "place long, doc long, score long"))
