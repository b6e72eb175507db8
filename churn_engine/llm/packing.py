"""Best-fit packing of tokenised documents by a grouping genetic algorithm on islands.

Items are dealt into blocks of bounded size. For each block several islands evolve a population of packings, each in a task of its
own; after each epoch an island's best packing moves to the next island. Crossover takes whole well-filled sequences
of one parent into the other, removes the sequences that hold the same documents, and best-fits the documents this
displaces. The fitness is the number of sequences, then the sum of squared fills, which prefers full ones.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churn_engine.llm.chunked_bpe import ChunkedBpe, encoded
from churn_engine.llm.common import in_slices, pieces, small_batches, store

CAPACITY = 1024
#: Items of a block, islands per block, epochs, generations of an epoch, packings of a population.
BLOCK, ISLANDS, EPOCHS, GENERATIONS, POPULATION = 16_384, 2, 2, 6, 4


def _cut(path: str, end_id: int, capacity: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkedBpe(path)
        number = TaskContext.get().partitionId() << 40
        for batch in in_slices(batches, "text", 1 << 19):
            doc, piece, start, length, crc = [], [], [], [], []
            for row, ids in enumerate(encoded(encoder, batch.column("text"))):
                raw = np.append(ids, end_id).astype("<u4")
                at, end = 0, len(raw) % capacity or capacity
                while at < len(raw):
                    doc.append(row)
                    piece.append(piece[-1] + 1 if at else 0)
                    start.append(at)
                    length.append(end - at)
                    crc.append(zlib.crc32(raw[at:end].tobytes()))
                    at, end = end, end + capacity
            numbers = np.arange(number, number + len(doc))
            number += len(doc)
            yield from pieces(
                {
                    "item": numbers,
                    "doc_id": batch.column("doc_id").take(pa.array(doc, pa.int64())),
                    "piece": pa.array(piece, pa.int32()),
                    "start": pa.array(start, pa.int64()),
                    "length": pa.array(length, pa.int64()),
                    "ids_crc32": pa.array(crc, pa.int64()),
                }
            )

    return run


class Packing:
    """Bins by item, with their fills."""

    def __init__(self, bins: np.ndarray, lengths: np.ndarray, capacity: int):
        self.bins = np.unique(bins, return_inverse=True)[1]
        self.fills = np.bincount(self.bins, lengths).astype(np.int64)
        self.fitness = (len(self.fills), -float(((self.fills / capacity) ** 2).sum()))


def best_fit(items: np.ndarray, lengths: np.ndarray, bins: np.ndarray, fills: np.ndarray, capacity: int) -> np.ndarray:
    """Put ``items``, in the given order, each into the fullest bin it fits, or a new one; returns all items' bins."""
    bins = bins.copy()
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_gaps = 0  # bit g: a bin has a gap of g
    gaps = capacity - fills
    for b in np.flatnonzero(gaps > 0).tolist():
        by_gap[gaps[b]].append(b)
    for g in range(1, capacity + 1):
        if by_gap[g]:
            open_gaps |= 1 << g
    fresh = len(fills)
    for item, size in zip(items.tolist(), lengths[items].tolist(), strict=True):
        fitting = open_gaps >> size
        if fitting:
            gap = size + (fitting & -fitting).bit_length() - 1
            b = by_gap[gap].pop()
            if not by_gap[gap]:
                open_gaps &= ~(1 << gap)
        else:
            gap, b, fresh = capacity, fresh, fresh + 1
        bins[item] = b
        rest = gap - size
        if rest:
            by_gap[rest].append(b)
            open_gaps |= 1 << rest
    return bins


def _born(lengths: np.ndarray, rng: np.random.Generator, capacity: int, noise: float) -> Packing:
    order = np.argsort(-(lengths + noise * rng.standard_normal(len(lengths))), kind="stable")
    none = np.zeros(0, np.int64)
    return Packing(best_fit(order, lengths, np.zeros(len(lengths), np.int64), none, capacity), lengths, capacity)


def crossover(a: Packing, b: Packing, lengths: np.ndarray, rng: np.random.Generator, capacity: int) -> Packing:
    """Whole well-filled bins of ``b`` go into ``a``."""
    full = np.flatnonzero(b.fills >= np.quantile(b.fills, 0.5))
    chosen = np.zeros(len(b.fills), bool)
    chosen[rng.choice(full, max(1, len(full) // 4), replace=False)] = True
    return _injected(a, chosen[b.bins], b.bins, lengths, rng, capacity, 0)


def _injected(a: Packing, brought: np.ndarray, theirs: np.ndarray, lengths: np.ndarray, rng, capacity: int, shake: int) -> Packing:
    """Bins of ``a`` with a document that is brought along are dissolved, as are ``shake`` of the least filled; what
    they leave is best-fitted, longest first."""
    gone = np.zeros(len(a.fills), bool)
    gone[a.bins[brought]] = True
    if shake:
        worst = np.argsort(a.fills + 0.1 * capacity * rng.random(len(a.fills)))[:shake]
        gone[worst] = True
    displaced = np.flatnonzero(gone[a.bins] & ~brought)
    bins = a.bins.copy()
    bins[brought] = len(a.fills) + theirs[brought]
    kept = ~gone[a.bins] | brought
    names, inner = np.unique(bins[kept], return_inverse=True)
    placed = np.zeros(len(bins), np.int64)
    placed[kept] = inner
    fills = np.bincount(inner, lengths[kept], len(names)).astype(np.int64)
    order = displaced[np.argsort(-lengths[displaced], kind="stable")]
    return Packing(best_fit(order, lengths, placed, fills, capacity), lengths, capacity)


def evolve(lengths: np.ndarray, population: list[Packing], seed: list[int], capacity: int, generations: int, size: int) -> list[Packing]:
    rng = np.random.default_rng(seed)
    least = -(-int(lengths.sum()) // capacity)
    while len(population) < size:
        population.append(_born(lengths, rng, capacity, 0.0 if not population else 2.0 * len(population)))
    for _ in range(generations):
        population.sort(key=lambda p: p.fitness)
        if population[0].fitness[0] <= least:
            break
        i, j = rng.choice(len(population), 2, replace=False)
        child = crossover(population[min(i, j)], population[max(i, j)], lengths, rng, capacity)
        nothing = np.zeros(len(lengths), bool)
        mutant = _injected(population[0], nothing, child.bins, lengths, rng, capacity, max(2, len(child.fills) // 50))
        population = sorted([*population, child, mutant], key=lambda p: p.fitness)[:size]
    return sorted(population, key=lambda p: p.fitness)


STATE = "block int, island int, items array<long>, lengths array<int>, population array<array<int>>, n_bins int, loss double"


def _epoch(number: int, capacity: int, generations: int, size: int) -> Callable:
    """One epoch of each island; ``migrant`` is another island's best packing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.to_pylist():
                lengths = np.array(x["lengths"], np.int64)
                known = [*x["population"], *([x["migrant"]] if x["migrant"] else [])]
                found = evolve(
                    lengths,
                    [Packing(np.array(p, np.int64), lengths, capacity) for p in known],
                    [x["block"], x["island"], number],
                    capacity,
                    generations,
                    size,
                )[:size]
                out = {
                    **{k: x[k] for k in ("block", "island", "items", "lengths")},
                    "population": [p.bins.tolist() for p in found],
                    "n_bins": found[0].fitness[0],
                    "loss": found[0].fitness[1],
                }
                yield pa.RecordBatch.from_pylist([out], schema=_STATE)

    return run


_STATE = pa.schema(
    [
        ("block", pa.int32()),
        ("island", pa.int32()),
        ("items", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int32())),
        ("population", pa.list_(pa.list_(pa.int32()))),
        ("n_bins", pa.int32()),
        ("loss", pa.float64()),
    ]
)


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for x in batch.to_pylist():
            bins, lengths = np.array(x["bins"], np.int64), np.array(x["lengths"], np.int64)
            order = np.argsort(bins, kind="stable")
            sums = np.cumsum(lengths[order]) - lengths[order]
            begins = np.r_[True, bins[order][1:] != bins[order][:-1]]
            offset = np.empty(len(bins), np.int64)
            offset[order] = sums - np.maximum.accumulate(np.where(begins, sums, 0))
            yield from pieces({"item": np.array(x["items"], np.int64), "sequence_id": (x["block"] << 32) + bins, "offset": offset})


def pack_documents(
    docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, block: int = BLOCK, islands: int = ISLANDS
) -> DataFrame:
    """One row per piece: ``id_col, piece, start, length, ids_crc32, sequence_id, offset``.

    A document is its ids and ``end_id``; longer ones are cut into pieces of ``capacity``, the first of which may be
    shorter. Full pieces are a sequence each. All others are dealt by hash into blocks of about ``block`` items; each block is
    packed on ``islands`` islands. A block leaves at most a few sequences unfilled, so blocks cost next to nothing.

    Defined cases: a null text is an empty one and holds just ``end_id``; ids may be null or repeat, each row is a document of
    its own; an empty table gives an empty result; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "item long, doc_id long, piece int, start long, length long, ids_crc32 long"
    cut = store(rows.mapInArrow(_cut(path, end_id, capacity), schema))
    open_pieces = cut.where(F.col("length") < capacity)
    blocks = max(1, -(-open_pieces.count() // block))
    dealt = open_pieces.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int"))
    state = dealt.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("item", "length"))).alias("x"))
    state = state.select(
        "block",
        F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"),
        F.col("x.item").alias("items"),
        F.col("x.length").cast("array<int>").alias("lengths"),
        F.expr("cast(array() as array<array<int>>)").alias("population"),
        F.lit(None).cast("array<int>").alias("migrant"),
    )
    for number in range(EPOCHS):
        # An island is one row and seconds of work: a task for each, which no coalescing joins.
        state = state.repartition(blocks * islands, "block", "island")
        state = store(state.mapInArrow(_epoch(number, capacity, GENERATIONS, POPULATION), STATE))
        moved = state.select("block", F.pmod(F.col("island") + 1, F.lit(islands)).alias("island"), F.col("population")[0].alias("migrant"))
        if number < EPOCHS - 1 and islands > 1:
            state = state.drop("n_bins", "loss").join(moved, ["block", "island"])
        elif number < EPOCHS - 1:
            state = state.drop("n_bins", "loss").withColumn("migrant", F.lit(None).cast("array<int>"))
    rank = F.struct("n_bins", "loss", "island")
    best = state.groupBy("block").agg(F.min(rank).alias("r")).select("block", F.col("r.island").alias("island"))
    won = state.join(best, ["block", "island"]).select("block", "items", "lengths", F.col("population")[0].alias("bins"))
    placed = won.mapInArrow(_placed, "item long, sequence_id long, offset long")
    own = cut.where(F.col("length") == capacity).withColumns({"sequence_id": -1 - F.col("item"), "offset": F.lit(0).cast("long")})
    return (
        cut.join(placed, "item")
        .unionByName(own)
        .select(F.col("doc_id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    )
