"""What the corpus operators share: tables, stored intermediates, bounded Arrow batches."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch on its way to Python, so that a batch of long texts stays small.
BATCH_ROWS = 1000
#: Rows of a batch on its way back.
OUT_ROWS = 50_000


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; where that is unset (tests), below a folder of our own."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        base = "file://" + tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def store(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors, keeps column pruning."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with as many underscores before each as make it no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def small_batches(spark: SparkSession) -> None:
    """Limit Arrow batches to ``BATCH_ROWS`` rows, unless the session asks for fewer."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def relieve() -> None:
    """Give back memory that earlier tasks of this worker have freed; workers live on from stage to stage."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def in_slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` holds about ``most`` bytes in each; a longer text comes alone."""
    relieve()
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = batch.column(column)
        ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(lengths), 0), dtype=np.int64))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(at, to - at)
            at = to


def pieces(columns: dict[str, np.ndarray | pa.Array]) -> Iterator[pa.RecordBatch]:
    """One set of long columns as record batches of ``OUT_ROWS`` rows."""
    arrays = [x if isinstance(x, pa.Array) else pa.array(x) for x in columns.values()]
    whole = pa.RecordBatch.from_arrays(arrays, names=list(columns))
    for at in range(0, whole.num_rows, OUT_ROWS):
        yield whole.slice(at, OUT_ROWS)


def pack(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, body): texts compressed for exchanges; ``unpacked`` undoes it. A null is an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in in_slices(batches, text_col):
            data, offsets = text_bytes(batch.column(text_col))
            bodies = [squeeze.compress(data[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(id_col), pa.array(bodies, pa.binary())], names=[id_col, "body"])

    return rows.select(id_col, text_col).mapInArrow(run, f"`{id_col}` long, body binary")


def unpacked(body: pa.Array) -> list[bytes]:
    expand = zstandard.ZstdDecompressor()
    return [expand.decompress(x) for x in body.to_pylist()]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and its offsets (one more than rows); a null is an empty text."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0] .. starts[0]+counts[0]-1, starts[1] .. and so on, one after the other."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - counts), counts)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an edge list: (node, component), component the smallest node reached.

    Alternates large-star and small-star steps: each node hands its neighbours to the smallest of them, so the
    longest path shrinks geometrically. Neighbours are never collected; a node with millions of edges is an
    aggregate with map-side combine and a join that can be split. Stored after each round; ends when no edge moves.
    """
    links = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v")
    links = store(links.distinct())
    state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    while True:
        # Large star: every neighbour above a node goes to the smallest of the node and its neighbours.
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Small star: the neighbours below a node, and the node, go to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = store(small.unionByName(least.withColumnRenamed("m", "v")).distinct())
        before, state = state, links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
    return links.select(F.explode(F.array("u", "v")).alias("node"), F.col("v").alias("component")).distinct()
