"""Token counts by a map-side two-tier lookup.

A piece vocabulary in which no entry has a word mark after another character never merges
across the start of a run of word marks, so the count of a text is the sum over its
pre-tokens (a run of spaces with the characters up to the next run).

1. One pass over all texts counts pre-tokens map-side. Each task keeps a bounded summary
   (a Misra-Gries sketch: when it outgrows its bound the smallest counts are taken off all),
   and summaries are merged pairwise in a tree, each again within the bound. No pre-token
   goes through a shuffle row by row: only the bounded summaries move.
2. The ``frequent`` most frequent pre-tokens are encoded once and broadcast as a compact
   table: their joined bytes and one small integer each (bounded by ``frequent`` entries).
3. Every text is counted map-side: first tier the broadcast table, second tier a bounded
   cache in each worker, filled by the library.

The table only saves time: any pre-token it lacks is encoded, so counts are exact.
Nulls: a NULL text is the empty text (0 tokens). Repeated rows each give a row.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logonlens.llm.byte_bpe import Memo, rarer_gc, slices
from logonlens.llm.common import document_rows

MARK = "▁"
_RUNS = re.compile(r" +[^ ]*")
FREQUENT = 65_536           # entries of the broadcast table
SUMMARY = 4 * FREQUENT      # entries of a task's summary
MAX_CHARS = 64              # longer pre-tokens are never kept


def pre_tokens(text: str) -> list[str]:
    """Pre-tokens without their first word mark (the library puts it back)."""
    if MARK in text:
        text = text.replace(MARK, " ")
    if not text:
        return []
    if "  " not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    return [run[1:] for run in _RUNS.findall(" " + text)]


def shrink(counts: Counter, bound: int) -> Counter:
    """Misra-Gries: take the count of the largest entry that does not fit off all others."""
    if len(counts) <= bound:
        return counts
    off = int(np.partition(np.fromiter(counts.values(), np.int64, len(counts)), -bound - 1)[-bound - 1])
    return Counter({k: c - off for k, c in counts.items() if c > off})


def _pack_summary(counts: Counter) -> bytes:
    blob = "\0".join(counts).encode()
    return zlib.compress(np.array([len(counts), len(blob)], "<u8").tobytes() + blob
                         + np.fromiter(counts.values(), "<u8", len(counts)).tobytes(), 1)


def _unpack_summary(data: bytes) -> Counter:
    raw = zlib.decompress(data)
    n, size = (int(x) for x in np.frombuffer(raw, "<u8", 2))
    names = raw[16:16 + size].decode().split("\0") if n else []
    return Counter(dict(zip(names, np.frombuffer(raw[16 + size:], "<u8", n).tolist(), strict=True)))


def frequent_pre_tokens(df: DataFrame, frequent: int = FREQUENT, summary: int = SUMMARY) -> list[str]:
    """The most frequent pre-tokens over all texts, most frequent first."""
    def work(batches):
        rarer_gc()
        counts: Counter = Counter()
        for part in slices(batches):
            for text in part.column(0).to_pylist():
                counts.update(pre_tokens(text))
            if len(counts) > 3 * summary:
                counts = shrink(counts, summary)
        for long in [k for k in counts if not 0 < len(k) <= MAX_CHARS or "\0" in k]:
            del counts[long]
        yield pa.RecordBatch.from_arrays([pa.array([_pack_summary(shrink(counts, summary))], pa.binary())],
                                         ["summary"])

    def merge(a: bytes, b: bytes) -> bytes:
        both = _unpack_summary(a)
        both.update(_unpack_summary(b))
        return _pack_summary(shrink(both, summary))

    summaries = df.select("text").mapInArrow(work, "summary binary").rdd.map(lambda r: bytes(r[0]))
    n = summaries.getNumPartitions()
    if n == 0:
        return []
    depth = max(2, int(np.ceil(np.log(max(2, n)) / np.log(8))))
    merged = _unpack_summary(summaries.treeReduce(merge, depth))
    return [k for k, _ in sorted(merged.items(), key=lambda x: (-x[1], x[0]))[:frequent]]


@lru_cache(maxsize=2)
def _library(model_path: str):
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=model_path)
    for i in range(library.get_piece_size()):
        piece = library.id_to_piece(i)
        if MARK in piece.lstrip(MARK):
            raise ValueError(f"piece {piece!r} has a word mark behind another character: texts cannot be cut at word marks")
    return library


def length_of(model_path: str):
    """``pre-token -> tokens`` by the library. The empty pre-token is a lone word mark at a
    text's end, which the library cannot be given alone."""
    library = _library(model_path)
    lone = 1 if library.piece_to_id(MARK) != library.unk_id() else len(MARK.encode())
    encode = library.encode
    return lambda pre: len(encode(pre)) if pre else lone


def compact_table(pre: list[str], lengths: list[int]) -> tuple[bytes, bytes]:
    """The broadcast form: zlib of the joined pre-tokens, and their lengths as bytes."""
    return zlib.compress("\0".join(pre).encode(), 6), np.array(lengths, "<u2").tobytes()


_TABLES: dict[int, Memo] = {}


def _lookup(key: int, table: tuple[bytes, bytes], model_path: str) -> Memo:
    """First tier and cache of this worker, made once for each broadcast table."""
    known = _TABLES.get(key)
    if known is None:
        _TABLES.clear()
        known = _TABLES[key] = TwoTier(length_of(model_path))
        lengths = np.frombuffer(table[1], "<u2").tolist()
        if lengths:
            known.frequent = dict(zip(zlib.decompress(table[0]).decode().split("\0"), lengths, strict=True))
            known.update(known.frequent)
    return known


class TwoTier(Memo):
    """The worker's cache; whenever it starts anew the broadcast entries come back first."""
    frequent: dict = {}

    def clear(self):
        super().clear()
        self.update(self.frequent)


def token_counts(df: DataFrame, model_path: str, limit: int, id_col: str = "doc_id",
                 text_col: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``df``."""
    docs = document_rows(df, id_col, text_col)
    pre = frequent_pre_tokens(docs, frequent)
    library = _library(model_path)
    lengths = [len(x) for x in library.encode(pre, num_threads=1)] if pre else []
    shared = docs.sparkSession.sparkContext.broadcast(compact_table(pre, lengths))
    key = uuid.uuid4().int

    def work(batches):
        rarer_gc()
        length = _lookup(key, shared.value, model_path).__getitem__
        for part in slices(batches):
            counts = [sum(map(length, pre_tokens(t))) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(counts, pa.int64())],
                                             ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.withColumn("n_bytes", F.octet_length("text").cast("long"))
    return (rows.mapInArrow(work, "doc_id long, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))
