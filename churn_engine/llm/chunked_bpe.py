"""BPE encoding and decoding by content-defined chunk reuse.

Texts are cut where a run of white space begins and a rolling hash of the bytes before it allows it, so equal content
is cut alike wherever it stands. Each distinct chunk is encoded once and its ids are reused in every document that
holds it. White space of ASCII after a plain character always ends a token, so most joins are exact by the rules of
both tokenizers; where a chunk ends in anything else, the joined chunks are encoded again as a whole and replace
the pieces unless both agree.

Plain chunks (printable ASCII and Latin letters) go through the fast encoder of the same vocabulary, all others, with their special
tokens, through the tokenizer itself.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churn_engine.llm import words
from churn_engine.llm.common import in_slices, ranges, small_batches, text_bytes

#: A white-space run is no cut where these bits of the rolling hash are all zero.
GLUE_BITS = np.uint64(31)
#: Bytes that the rolling hash looks back over.
LOOK_BACK = 8
#: Distinct chunks that a task remembers; beyond, it starts afresh.
REMEMBERED = 100_000

#: Byte classes: 0 plain, 1 ASCII white space of plain texts, 2 lead byte of U+00C0 to U+00FF letters and U+0100 to U+023F, 3 anything else.
_KIND = np.full(256, 3, np.uint8)
_KIND[0x21:0x7F] = 0
_KIND[[0x20, 0x09, 0x0A, 0x0D]] = 1
_KIND[0xC3:0xC9] = 2
_KIND[0x80:0xC0] = 4  # goes with its lead byte


class ChunkedBpe:
    """Encoder for one vocabulary file of the tokenizers library: byte-level BPE, or BPE with ``</w>`` word ends."""

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        self.word_ends = told["model"].get("end_of_word_suffix") == "</w>"
        vocabulary = told["model"]["vocab"]
        self.special = [x["content"] for x in told["added_tokens"]]
        size = 1 + max([*vocabulary.values(), *(x["id"] for x in told["added_tokens"])])
        self.tokens = [""] * size
        for token, i in [*vocabulary.items(), *((x["content"], x["id"]) for x in told["added_tokens"])]:
            self.tokens[i] = token
        self._vocabulary = vocabulary
        self.forget()

    generation = 0

    def forget(self) -> None:
        self.generation += 1
        self.index: dict[int, int] = {}
        self.ids = np.zeros(1 << 16, np.int32)
        self.used = 0
        self.starts: list[int] = []
        self.counts: list[int] = []

    @cached_property
    def tokenizer(self):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        found = Tokenizer.from_file(self.path)
        found.no_truncation()
        found.no_padding()
        return found

    @cached_property
    def fast(self):
        """The same merges as ranks. NUL, which no plain chunk has, ends a word or separates chunks."""
        import tiktoken

        byte_of = _bytes_of_letters()
        ranks = {}
        for token, i in self._vocabulary.items():
            if token in self.special:
                continue
            end = self.word_ends and token.endswith("</w>")
            body = token[:-4] if end else token
            if all(c in byte_of for c in body):
                ranks[bytes(byte_of[c] for c in body) + b"\0" * end] = i
        if self.word_ends:
            pattern = r"[^\x00]+\x00"
        else:
            pattern = r"\x00|'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}\x00]+|\s+(?![^\s\x00])|\s+"
        return tiktoken.Encoding("chunks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def slow(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _encode_plain(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks, and how many each has."""
        if not chunks:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        if not self.word_ends:
            ids = np.array(self.fast.encode_ordinary("\0".join(chunks) + "\0"), np.int32)
            ends = np.flatnonzero(ids == self._vocabulary[_letters_of_bytes()[0]])
            return np.delete(ids, ends), np.diff(np.r_[-1, ends]) - 1
        pieces = [self._split(c) for c in map(str.lower, chunks)]
        flat = [p for x in pieces for p in x]
        of_chunk = np.array([len(x) for x in pieces])
        if not flat:
            return np.zeros(0, np.int32), np.zeros(len(chunks), np.int64)
        ids = np.array(self.fast.encode_ordinary("\0".join(flat) + "\0"), np.int32)
        ends = np.flatnonzero(self._is_end[ids]) + 1
        sums = np.r_[0, ends][np.r_[0, np.cumsum(of_chunk)]]
        return ids, np.diff(sums)

    @cached_property
    def _special_starts(self) -> set[tuple[int, int]]:
        return {(x.encode()[0], x.encode()[1]) for x in self.special if len(x.encode()) > 1}

    @cached_property
    def _is_end(self) -> np.ndarray:
        return np.array([t.endswith("</w>") for t in self.tokens])

    @cached_property
    def _split(self) -> Callable[[str], list[str]]:
        import regex

        return regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+").findall

    def _remember(self, keys: list[int], ids: np.ndarray, counts: np.ndarray) -> None:
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.zeros(max(len(self.ids), len(ids)), np.int32)])
        self.ids[self.used : self.used + len(ids)] = ids
        begins = self.used + np.cumsum(counts) - counts
        at = len(self.starts)
        self.starts.extend(begins.tolist())
        self.counts.extend(counts.tolist())
        self.index.update(zip(keys, range(at, at + len(keys)), strict=True))
        self.used += len(ids)

    def cuts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts of chunks, whether each is plain, and whether the join at its start is exact by rule."""
        n = len(data)
        kind = _KIND[data]
        white = words.WHITE[data]
        run = np.empty(n, bool)
        run[0], run[1:] = False, white[1:] & ~white[:-1]
        at = np.flatnonzero(run)
        at = at[at >= LOOK_BACK]
        rolled = np.zeros(len(at), np.uint64)
        for k in range(1, LOOK_BACK + 1):
            rolled = rolled * words.BASE + words.LETTERS[data[at - k]]
        at = at[(words.mixed(rolled) & GLUE_BITS) != 0]
        first = np.zeros(n, bool)
        first[offsets[:-1][np.diff(offsets) > 0]] = True
        taken = first.copy()
        taken[at] = True
        starts = np.flatnonzero(taken)
        odd = kind == 3
        # Of lead byte C3, only the letters: U+00D7 and U+00F7 are signs.
        lead = np.flatnonzero(data[:-1] == 0xC3)
        odd[lead] |= (data[lead + 1] == 0x97) | (data[lead + 1] == 0xB7)
        for a, b in self._special_starts:
            odd[:-1] |= (data[:-1] == a) & (data[1:] == b)
        plain = ~np.logical_or.reduceat(odd, starts)
        exact = np.ones(len(starts), bool)
        # The byte before a cut: plain ASCII, or the end of a chunk that is all plain.
        exact[1:] = first[starts[1:]] | plain[:-1] | (kind[starts[1:] - 1] == 0)
        if not self.word_ends:  # white space at the end of a text is a token of its own kind
            ends = np.r_[starts[1:], n]
            plain &= ~white[ends - 1]
        return starts, plain, exact

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For the texts of a column: the chunk number of each chunk in order, each text's first chunk (one more than
        texts); with ``chunk_ids`` these give ids. Also all chunks' starts and counts in ``ids`` as arrays."""
        data, offsets = text_bytes(column)
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(self.starts) > REMEMBERED:
            self.forget()
        starts, plain, exact = self.cuts(data, offsets)
        ends = np.r_[starts[1:], len(data)]
        first = np.searchsorted(starts, offsets)
        keys = words.span_hashes(data, starts, ends) * np.uint64(2) + plain
        codes, distinct = pd.factorize(keys)
        numbers = np.array([self.index.get(k, -1) for k in distinct.tolist()])
        missing = np.flatnonzero(numbers < 0)
        if len(missing):
            where = np.empty(len(distinct), np.int64)
            where[codes[::-1]] = np.arange(len(codes))[::-1]  # the first of each
            where = where[missing]
            raw = data.tobytes()
            fits = plain[where]
            simple = missing[fits]
            texts = [raw[a:b].decode() for a, b in zip(starts[where[fits]].tolist(), ends[where[fits]].tolist(), strict=True)]
            self._remember(distinct[simple].tolist(), *self._encode_plain(texts))
            other = missing[~fits]
            if len(other):
                texts = [raw[a:b].decode() for a, b in zip(starts[where[~fits]].tolist(), ends[where[~fits]].tolist(), strict=True)]
                found = [self.slow(t) for t in texts]
                counts = np.array([len(x) for x in found])
                self._remember(distinct[other].tolist(), np.array([i for x in found for i in x], np.int32), counts)
            numbers[missing] = [self.index[k] for k in distinct[missing].tolist()]
        chunk = numbers[codes]
        if not exact.all():
            chunk, first = self._repair(data, starts, ends, exact, chunk, first)
        return chunk, first, np.array(self.starts, np.int64), np.array(self.counts, np.int64)

    def _repair(self, data, starts, ends, exact, chunk, first) -> tuple[np.ndarray, np.ndarray]:
        """Encode each run of chunks with unproven joins as one; where the pieces disagree, the whole takes the
        place of the first and the others become empty."""
        chunk = chunk.copy()
        begins = np.flatnonzero(exact)
        empty = None
        for a, b in zip(begins.tolist(), [*begins[1:].tolist(), len(starts)], strict=True):
            if b - a < 2:
                continue
            ids = self.slow(data[int(starts[a]) : int(ends[b - 1])].tobytes().decode())
            if ids != [i for c in chunk[a:b].tolist() for i in self.chunk_ids(c).tolist()]:
                if empty is None:
                    self._remember([-1], np.zeros(0, np.int32), np.zeros(1, np.int64))
                    empty = len(self.starts) - 1
                self._remember([-2], np.array(ids, np.int32), np.array([len(ids)]))
                chunk[a:b] = empty
                chunk[a] = len(self.starts) - 1
        return chunk, first

    def chunk_ids(self, number: int) -> np.ndarray:
        return self.ids[self.starts[number] : self.starts[number] + self.counts[number]]


class ChunkTexts:
    """What chunks look like written out: their ids as decimals, and decoded."""

    def __init__(self, encoder: ChunkedBpe):
        self.encoder, self.decimal, self.decoded, self.generation = encoder, [], [], encoder.generation
        self.digits = [str(i) for i in range(len(encoder.tokens))]

    def catch_up(self) -> None:
        encoder = self.encoder
        if self.generation != encoder.generation:
            self.decimal, self.decoded, self.generation = [], [], encoder.generation
        at = len(self.decimal)
        if at == len(encoder.starts):
            return
        ids = encoder.ids[: encoder.used].tolist()
        for a, n in zip(encoder.starts[at:], encoder.counts[at:], strict=True):
            part = ids[a : a + n]
            self.decimal.append(" ".join([self.digits[i] for i in part]))
            self.decoded.append(" ".join([encoder.tokens[i] for i in part]))


def _letters_of_bytes() -> list[str]:
    """Byte-level BPE writes each byte as a printable letter: printable bytes as themselves, the others, in order, from
    U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in set(printable) else chr(next(others)) for b in range(256)]


def _bytes_of_letters() -> dict[str, int]:
    return {letter: b for b, letter in enumerate(_letters_of_bytes())}


def encoded(encoder: ChunkedBpe, column: pa.Array) -> Iterator[np.ndarray]:
    """The ids of each text."""
    chunk, first, starts, counts = encoder.encode(column)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        part = chunk[a:b]
        yield encoder.ids[ranges(starts[part], counts[part])]


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = True) -> DataFrame:
    """One row per input row: ``id_col, n_tokens, ids_sha256, decoded_sha256`` and, with ``ids``, ``ids`` and ``decoded``.

    For a vocabulary of words with ends: encodes each whole text and decodes the ids again, special tokens included. There is no shuffle; a
    task remembers the chunks of its documents up to a bound.

    Defined cases: a null text is an empty one and gives no ids; a null id stays null; repeated rows give repeated results; an empty
    table gives an empty result; other columns are ignored.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkedBpe(path)
        written = ChunkTexts(encoder)
        for batch in in_slices(batches, "text", 1 << 19):
            chunk, first, starts, counts = encoder.encode(batch.column("text"))
            written.catch_up()
            counts_of = counts[chunk] if len(chunk) else np.zeros(0, np.int64)
            sums = np.r_[0, np.cumsum(counts_of)]
            numbers, filled = chunk.tolist(), (counts_of > 0).tolist()
            digests, decodings, texts = [], [], []
            for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                part = [c for c, f in zip(numbers[a:b], filled[a:b], strict=True) if f]
                digests.append(hashlib.sha256(" ".join([written.decimal[c] for c in part]).encode()).hexdigest())
                decoded = " ".join([written.decoded[c] for c in part])
                decodings.append(hashlib.sha256(decoded.encode()).hexdigest())
                if ids:
                    texts.append(decoded)
            out = {
                "doc_id": batch.column("doc_id"),
                "n_tokens": pa.array(sums[first[1:]] - sums[first[:-1]], pa.int64()),
                "ids_sha256": pa.array(digests, pa.string()),
                "decoded_sha256": pa.array(decodings, pa.string()),
            }
            if ids:
                out["ids"] = pa.array([x.tolist() for x in encoded(encoder, batch.column("text"))], pa.list_(pa.int32()))
                out["decoded"] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * ids
    return rows.mapInArrow(run, schema).withColumnRenamed("doc_id", id_col)
