"""Substring dedup with difference-cover anchors.

Positions of a text whose index modulo 31 lies in a perfect difference cover carry an anchor: a hash of the 20 words
from there. Whatever the offset between two equal runs of 50 words, one of the first 31 positions is on the cover in
both, and its anchor lies inside the run. So only windows that hold an anchor found in two documents can repeat;
they alone are hashed in full and compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churn_engine.llm import words
from churn_engine.llm.common import in_slices, pack, pieces, small_batches, store, text_bytes, unpacked, unused

#: A perfect difference set modulo 31, every difference occurs.
PERIOD = 31
COVER = np.array([1, 5, 11, 24, 25, 27])
ON_COVER = np.isin(np.arange(PERIOD), COVER)
#: Words of a window and of an anchor; ``PERIOD - 1 + ANCHOR`` must not exceed ``WINDOW``.
WINDOW = 50
ANCHOR = WINDOW - PERIOD + 1
BITS32 = np.uint64((1 << 32) - 1)


def _hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = words.word_spans(data, offsets)
    return words.span_hashes(data, starts, ends), first


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_slices(batches, "text"):
        hashes, first = _hashes(*text_bytes(batch.column("text")))
        long_enough = np.diff(first) >= WINDOW
        at, which = words.within(first, ANCHOR)
        keep = ON_COVER[(at - first[which]) % PERIOD] & long_enough[which]
        at, which = at[keep], which[keep]
        if len(at):
            ids = np.asarray(batch.column("doc_id"))
            yield from pieces(
                {
                    "h": words.joined(hashes, ANCHOR)[at].view(np.int64),
                    "doc_id": ids[which],
                    "pos": (at - first[which]).astype(np.int32),
                }
            )


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (h, doc_id), those whose h occurs in two documents. Only the rows of a hash's smallest
    document wait for the next batch, so memory doesn't grow with a hash's rows."""
    waiting: dict[str, np.ndarray] | None = None
    known: int | None = None
    for batch in batches:
        x = {c: np.asarray(batch.column(c)) for c in ("h", "doc_id", "pos")}
        if known is not None:
            same = int(np.searchsorted(x["h"], known, side="right"))
            yield from pieces({"doc_id": x["doc_id"][:same], "pos": x["pos"][:same]})
            x = {c: v[same:] for c, v in x.items()}
        if not len(x["h"]):
            continue
        if waiting is not None:
            x = {c: np.concatenate([waiting[c], v]) for c, v in x.items()}
        h, doc = x["h"], x["doc_id"]
        begins = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        counts = np.diff(np.r_[begins, len(h)])
        several = doc[begins + counts - 1] != doc[begins]
        out = np.repeat(several, counts)
        yield from pieces({"doc_id": doc[out], "pos": x["pos"][out]})
        known = h[-1] if several[-1] else None
        waiting = None if several[-1] else {c: v[begins[-1] :].copy() for c, v in x.items()}


def _window_keys(hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of the windows that start at ``at``: 64 bits, and 32 bits more."""
    one = words.joined(hashes, WINDOW)[at]
    two = words.joined(words.mixed(hashes ^ np.uint64(0x5851F42D4C957F2D)), WINDOW)[at] & BITS32
    return one, two


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows that hold a repeated anchor: both hashes, document, start."""
    for batch in batches:
        batch = batch.filter(batch.column("anchors").is_valid())
        for row, body in enumerate(unpacked(batch.column("body"))):
            data = np.frombuffer(body, np.uint8)
            hashes, first = _hashes(data, np.array([0, len(data)]))
            n = len(hashes) - WINDOW + 1
            if n <= 0:
                continue
            anchors = np.unique(batch.column("anchors")[row].values.to_numpy(zero_copy_only=False))
            marks = np.zeros(n + 1, np.int64)
            low = np.maximum(0, anchors - (WINDOW - ANCHOR))
            fits = low < n
            np.add.at(marks, low[fits], 1)
            np.add.at(marks, np.minimum(n, anchors[fits] + 1), -1)
            at = np.flatnonzero(np.cumsum(marks[:-1]) > 0)
            if len(at):
                one, two = _window_keys(hashes, at)
                yield from pieces(
                    {
                        "h": one.view(np.int64),
                        "doc_id": np.full(len(at), batch.column("doc_id")[row].as_py(), np.int64),
                        "key": ((two << np.uint64(32)) | at.astype(np.uint64)).view(np.int64),
                    }
                )


def _later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (h, second hash, doc_id), those whose window also starts in a smaller document."""
    last: tuple[int, int, int] | None = None
    for batch in batches:
        h, doc, key = (np.asarray(batch.column(c)) for c in ("h", "doc_id", "key"))
        if not len(h):
            continue
        two = key.view(np.uint64) >> np.uint64(32)
        begins = np.r_[True, (h[1:] != h[:-1]) | (two[1:] != two[:-1])]
        if last is not None and (h[0], two[0]) == last[:2]:
            begins[0] = False
        at = np.maximum.accumulate(np.where(begins, np.arange(len(h)), -1))
        least = np.where(at >= 0, doc[at], last[2] if last else 0)
        out = doc > least
        last = (h[-1], two[-1], least[-1])
        if out.any():
            yield from pieces({"doc_id": doc[out], "key": key[out]})


def _removed(hashes: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """A mark for each word covered by one of the windows ``keys``, whose second hash must be this text's."""
    n = len(hashes) - WINDOW + 1
    marks = np.zeros(len(hashes) + 1, np.int64)
    keys = np.unique(keys.view(np.uint64))
    at = (keys & BITS32).astype(np.int64)
    keys, at = keys[at < n], at[at < n]
    if len(at):
        at = at[_window_keys(hashes, at)[1] == keys >> np.uint64(32)]
        np.add.at(marks, at, 1)
        np.add.at(marks, at + WINDOW, -1)
    return np.cumsum(marks[:-1]) > 0


def _cut(batches: Iterator[pa.RecordBatch], texts: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, counts, removed, own = [], [], [], []
        keys = batch.column("keys")
        for row, body in enumerate(unpacked(batch.column("body"))):
            split = body.split()
            own.append(hashlib.sha256(body).hexdigest() if texts else None)
            counts.append(len(split))
            gone = 0
            if keys[row].is_valid:
                data = np.frombuffer(body, np.uint8)
                hashes, _ = _hashes(data, np.array([0, len(data)]))
                drop = _removed(hashes, keys[row].values.to_numpy(zero_copy_only=False))
                gone = int(drop.sum())
                split = [w for w, d in zip(split, drop.tolist(), strict=True) if not d]
            removed.append(gone)
            kept.append(b" ".join(split))
        out = {
            "doc_id": batch.column("doc_id"),
            "n_words": pa.array(counts, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
        }
        if texts:
            out["own_sha256"] = pa.array(own, pa.string())
            out["kept_text"] = pa.array(kept, pa.binary()).cast(pa.string())
        yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", texts: bool = True) -> DataFrame:
    """One row per input row: ``id_col, n_words, n_removed, kept_sha256`` and, with ``texts``, ``own_sha256`` (of the text as it was) and ``kept_text``.

    A window is 50 consecutive words; each word covered by a window whose words also start in a document with a
    smaller id goes. ``kept_text`` is what is left, joined by one space; ``kept_sha256`` is of its UTF-8.

    Steps: anchors of all texts are dealt out by their hash and sorted, those in one document only are dropped; the
    windows around the others are hashed with 96 bits, dealt out and sorted again, and each is compared with the
    smallest document of its run. Both passes stream over sorted rows, so a passage in a third of all documents is
    read in bounded memory, and no pair of documents is ever made. Texts travel compressed.

    Defined cases: a null text has no words; a row with a null id keeps all words and takes none from others; rows
    with one id, of equal or different text, take nothing from each other; a text of fewer than 50 words is kept;
    an empty table gives an empty result; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    anchors = rows.where("doc_id IS NOT NULL AND text IS NOT NULL").mapInArrow(_anchors, "h long, doc_id long, pos int")
    anchors = anchors.repartition("h").sortWithinPartitions("h", "doc_id")
    shared = anchors.mapInArrow(_repeated, "doc_id long, pos int").groupBy("doc_id").agg(F.collect_list("pos").alias("anchors"))
    packed = pack(rows, "doc_id", "text")
    # Both joins are left joins of all texts, so that Spark deals the texts out once and reads that exchange twice.
    windows = packed.join(shared, "doc_id", "left").mapInArrow(_windows, "h long, doc_id long, key long")
    windows = windows.repartition("h").sortWithinPartitions("h", F.shiftrightunsigned("key", 32), "doc_id")
    later = windows.mapInArrow(_later, "doc_id long, key long").groupBy("doc_id").agg(F.collect_list("key").alias("keys"))
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", own_sha256 string, kept_text string" * texts
    cut = packed.join(later, "doc_id", "left").mapInArrow(lambda batches: _cut(batches, texts), schema)
    return cut.withColumnRenamed("doc_id", id_col)


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated words taken out of the text (an untouched text stays as it is, a row whose words all
    go is dropped) and ``n_chars``, where there is one, counted anew. Other columns follow by id and text, so rows that repeat an id
    keep their own texts; equal rows stay equal rows. Other cases as in ``cut_repeats``."""
    names = docs.columns
    id_name, own_name, text_name = unused(docs, "__id", "__own", "__text")
    kept = cut_repeats(docs, id_col, text_col).where("n_removed > 0")
    kept = kept.select(F.col(id_col).alias(id_name), F.col("own_sha256").alias(own_name), F.col("kept_text").alias(text_name))
    kept = store(kept.dropDuplicates([id_name, own_name]))
    own = F.sha2(F.col(text_col).cast("binary"), 256)
    out = docs.join(kept, (F.col(id_col).cast("long") == F.col(id_name)) & (own == F.col(own_name)), "left")
    text = F.col(text_name)
    out = out.where(text.isNull() | (text != ""))
    changed = {text_col: F.coalesce(text, F.col(text_col))}
    if "n_chars" in names:
        changed["n_chars"] = F.when(text.isNotNull(), F.length(text)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return out.withColumns(changed).select(*names)
