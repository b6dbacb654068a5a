"""Token ids as fixed-width bit-packed binary files.

Every id takes the fewest bits that hold the largest id of the vocabulary. A file is::

    header   "IDPK", then as little-endian u32: version, bits per id, ids per block
    blocks   packed ids; every block starts at a 64-bit boundary (the last one is padded)
    index    for every document: doc_id (i64), its null flag (u8), end (u64, in ids from the
             file's start); then the byte offset of every block (u64)
    footer   u64 each: ids, documents, blocks, byte offset of the index; then the index's crc32
             (u32) and "IDPK"

so one document, or any span of ids, is read by its blocks alone, and a block is unpacked
by numpy without a loop over ids.

The ids are in ascending doc_id order over all files together: the documents are range-
partitioned and sorted by Spark, each task encodes its range and writes one file. File names
hold the task's attempt, and only files named in the committed manifest count, so a lost or
repeated task leaves at most an unused file.

Nulls: a NULL text is the empty text (the end id alone); a NULL doc_id sorts first and comes
back as NULL. Documents of equal doc_id stand in the order of their texts' hashes (then of the texts); each repeated row
is a document of its own. An empty table gives a manifest without files.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logonlens.llm.byte_bpe import MAX_MEMO, MAX_MEMO_CHARS, rarer_gc, slices
from logonlens.llm.common import cut, document_rows, split_at_spaces

MAGIC, VERSION = b"IDPK", 1
HEADER, FOOTER = struct.Struct("<4s3I"), struct.Struct("<4QI4s")
LANE = 64                       # ids that together fill whole 64-bit words
BLOCK_IDS = 4096                # ids per block: the unit of random access
WRITE_IDS = 64 * BLOCK_IDS      # ids packed at once
LINE_PIECES = 64                # new pieces in a line that the library gets
LINES = 64                      # and lines it gets at once
TOGETHER_CHARS = 1 << 20        # characters of texts whose new pieces it gets together, about


# ---------------------------------------------------------------- bit packing

def bits_for(vocabulary: int) -> int:
    """Bits that hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Little-endian bit stream of ``ids``, padded with zeros to whole groups of 64 ids."""
    lanes = np.zeros((-(-len(ids) // LANE), LANE), dtype=np.uint64)
    lanes.reshape(-1)[:len(ids)] = ids
    words = np.zeros((len(lanes), bits), dtype="<u8")
    for k in range(LANE):
        word, shift = divmod(k * bits, 64)
        words[:, word] |= lanes[:, k] << np.uint64(shift)
        if shift + bits > 64:
            words[:, word + 1] |= lanes[:, k] >> np.uint64(64 - shift)
    return words.tobytes()


def unpack(data: bytes, bits: int, count: int) -> np.ndarray:
    words = np.frombuffer(data, dtype="<u8").reshape(-1, bits)
    lanes = np.empty((len(words), LANE), dtype=np.uint64)
    mask = np.uint64((1 << bits) - 1)
    for k in range(LANE):
        word, shift = divmod(k * bits, 64)
        value = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            value |= words[:, word + 1] << np.uint64(64 - shift)
        lanes[:, k] = value & mask
    return lanes.reshape(-1)[:count].astype("<u4")


class Writer:
    """Writes one file; blocks go out as they fill, only the index is held."""

    def __init__(self, sink, bits: int, block_ids: int = BLOCK_IDS):
        if block_ids % LANE:
            raise ValueError(f"block_ids must be a multiple of {LANE}")
        self.sink, self.bits, self.block_ids = sink, bits, block_ids
        sink.write(HEADER.pack(MAGIC, VERSION, bits, block_ids))
        self.at = HEADER.size
        self.doc_ids, self.nulls, self.ends, self.offsets = [], [], [], []
        self.waiting, self.n_waiting, self.n_ids = [], 0, 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.n_ids += len(ids)
        self.doc_ids.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.ends.append(self.n_ids)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= WRITE_IDS:
            self._flush(whole_blocks=True)

    def _flush(self, whole_blocks: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, "<u4")
        n = len(ids) // self.block_ids * self.block_ids if whole_blocks else len(ids)
        block_bytes = self.block_ids // LANE * self.bits * 8
        self.offsets.extend(self.at + i * block_bytes for i in range(-(-n // self.block_ids)))
        packed = pack(ids[:n], self.bits)
        self.sink.write(packed)
        self.at += len(packed)
        self.waiting, self.n_waiting = [ids[n:]], len(ids) - n

    def close(self) -> None:
        self._flush(whole_blocks=False)
        index = b"".join((np.array(self.doc_ids, "<i8").tobytes(), np.array(self.nulls, "u1").tobytes(),
                          np.array(self.ends, "<u8").tobytes(), np.array(self.offsets, "<u8").tobytes()))
        self.sink.write(index)
        self.sink.write(FOOTER.pack(self.n_ids, len(self.ends), len(self.offsets), self.at,
                                    zlib.crc32(index), MAGIC))


class Reader:
    """Random access to one file by its index."""

    def __init__(self, source):
        self.source = source
        source.seek(0)
        magic, version, self.bits, self.block_ids = HEADER.unpack(source.read(HEADER.size))
        size = source.seek(0, 2)
        source.seek(size - FOOTER.size)
        self.n_ids, n_docs, n_blocks, at, crc, end = FOOTER.unpack(source.read(FOOTER.size))
        if (magic, end, version) != (MAGIC, MAGIC, VERSION):
            raise ValueError("not a packed id file")
        source.seek(at)
        index = source.read(size - FOOTER.size - at)
        if zlib.crc32(index) != crc:
            raise ValueError("the index of a packed id file is damaged")
        self.end_of_blocks = at
        self.doc_ids = np.frombuffer(index, "<i8", n_docs)
        self.nulls = np.frombuffer(index, "u1", n_docs, 8 * n_docs).astype(bool)
        self.ends = np.frombuffer(index, "<u8", n_docs, 9 * n_docs).astype(np.int64)
        self.offsets = np.frombuffer(index, "<u8", n_blocks, 17 * n_docs).astype(np.int64)

    def span(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the file, from the blocks that hold them."""
        if start >= stop:
            return np.zeros(0, "<u4")
        first, last = start // self.block_ids, (stop - 1) // self.block_ids
        until = self.offsets[last + 1] if last + 1 < len(self.offsets) else self.end_of_blocks
        self.source.seek(int(self.offsets[first]))
        data = self.source.read(int(until - self.offsets[first]))
        skip = start - first * self.block_ids
        return unpack(data, self.bits, skip + stop - start)[skip:]

    def document(self, row: int) -> np.ndarray:
        return self.span(int(self.ends[row - 1]) if row else 0, int(self.ends[row]))

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """All documents in order, a bounded run of blocks at a time: id, start, ids."""
        row, start = 0, 0
        while row < len(self.ends):
            stop = max(row + 1, int(np.searchsorted(self.ends, start + WRITE_IDS, "right")))
            ids = self.span(start, int(self.ends[stop - 1]))
            for r in range(row, stop):
                begin = int(self.ends[r - 1]) if r else 0
                yield (None if self.nulls[r] else int(self.doc_ids[r]), begin,
                       ids[begin - start:int(self.ends[r]) - start])
            row, start = stop, int(self.ends[stop - 1])


def open_file(path: str, mode: str):
    """A file of any store that pyarrow reaches (local paths, file://, s3://, gs://, hdfs://)."""
    files, inner = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (
        pafs.LocalFileSystem(), path)
    if mode == "rb":
        return files.open_input_file(inner)
    files.create_dir(os.path.dirname(inner), recursive=True)
    return files.open_output_stream(inner)


# ---------------------------------------------------------------- encoding

class LibraryEncoder:
    """Ids by the tokenizers library. A text is cut at single spaces between other
    characters, where its split pattern always starts anew, and pieces met before are
    looked up; a text that holds an added token's string goes to the library whole.

    New pieces go to the library many at a time, joined to lines again. The bytes of the ids, which
    are those of the line, tell which ids are whose; where they do not, pieces go one by one."""

    def __init__(self, path: str, bound: int = MAX_MEMO):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        # a letter stands for a byte in such a vocabulary
        vocabulary = self.library.get_vocab()
        self.size = np.zeros(1 + max(vocabulary.values(), default=0), np.int64)
        self.size[list(vocabulary.values())] = [len(entry) for entry in vocabulary]
        self.bound = bound
        self.known: dict[str, bytes] = {}           # a piece to the ids of a space and the piece
        self.old: dict[str, bytes] = {}             # the same before ``known`` was full

    def _whole(self, text: str) -> bytes:
        ids = self.library.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _lines(self, lines: list[list[str]]) -> Iterator[bytes]:
        """The ids of every piece of ``lines``."""
        found = self.library.encode_batch_fast([f" {' '.join(line)}" for line in lines], add_special_tokens=False)
        for line, ids in zip(lines, (np.array(x.ids, "<u4") for x in found), strict=True):
            ends = np.cumsum([1 + len(piece.encode()) for piece in line])
            token_ends = np.cumsum(self.size[ids])
            upto = np.searchsorted(token_ends, ends, "right")
            if len(ids) and token_ends[-1] == ends[-1] and (token_ends[upto - 1] == ends).all():
                data, edges = ids.tobytes(), [0, *(4 * upto).tolist()]
                yield from map(data.__getitem__, map(slice, edges[:-1], edges[1:]))
            else:
                yield from (self._whole(" " + piece) for piece in line)

    def _make(self, pieces: set[str]) -> dict[str, bytes]:
        """The ids of new ``pieces``."""
        made = {piece: self.old[piece] for piece in pieces & self.old.keys()}
        pieces = pieces.difference(made)
        joined = [piece for piece in pieces if piece and not piece[-1].isspace()]
        made.update((piece, self._whole(" " + piece)) for piece in pieces.difference(joined))
        lines = [joined[at:at + LINE_PIECES] for at in range(0, len(joined), LINE_PIECES)]
        for at in range(0, len(lines), LINES):
            part = lines[at:at + LINES]
            made.update(zip(chain.from_iterable(part), self._lines(part), strict=True))
        return made

    def encode_all(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of every text, in order; texts of about ``TOGETHER_CHARS`` are worked on at once."""
        texts = iter(texts)
        while True:
            held, size, get = [], 0, self.known.get
            for text in texts:
                whole = not text or any(t in text for t in self.added)
                pieces = [text] if whole else split_at_spaces(text)
                found = list(map(get, pieces))
                found[0] = self._whole(pieces[0])                   # no space stands before it
                held.append((found, [(k, pieces[k]) for k, ids in enumerate(found) if ids is None]))
                size += len(text)
                if size >= TOGETHER_CHARS:
                    break
            if not held:
                return
            made = self._make({piece for _, missing in held for _, piece in missing})
            for found, missing in held:
                for k, piece in missing:
                    found[k] = made[piece]
                yield b"".join(found)
            if len(self.known) >= self.bound:
                self.old, self.known = self.known, {}
            self.known.update((piece, ids) for piece, ids in made.items() if len(piece) <= MAX_MEMO_CHARS)

    def encode(self, text: str) -> bytes:
        return next(self.encode_all([text]))


@lru_cache(maxsize=2)
def _library(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


def write(df: DataFrame, path: str, tokenizer_path: str, vocabulary: int, end_id: int,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text, append ``end_id`` and write packed files under ``path``. Returns the
    committed manifest: ``part, file, n_docs, n_ids, base`` (ids in all files before)."""
    bits = bits_for(vocabulary)

    def work(batches):
        rarer_gc()
        encoder, end = _library(tokenizer_path), struct.pack("<I", end_id)
        task = TaskContext.get()
        part = task.partitionId()
        file = f"{path}/part-{part:06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}.idpk"
        sink = writer = None
        for rows in slices(batches):
            if writer is None:
                sink = open_file(file, "wb")
                writer = Writer(sink, bits)
            texts = (text.as_py() for text in rows.column(1))
            for doc_id, ids in zip(rows.column(0).to_pylist(), encoder.encode_all(texts), strict=True):
                writer.add(doc_id, np.frombuffer(ids + end, "<u4"))
        if writer is not None:
            writer.close()
            sink.close()
            yield pa.RecordBatch.from_pylist([{"part": part, "file": file, "n_docs": len(writer.ends),
                                               "n_ids": writer.n_ids}], schema)

    schema = pa.schema([("part", pa.int64()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])
    ordered = (document_rows(df, id_col, text_col).withColumn("h", F.xxhash64("text"))
               .repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text"))
    manifest = cut(ordered.select("doc_id", "text")
                   .mapInArrow(work, "part long, file string, n_docs long, n_ids long"), "idpk-manifest")
    # one row per file, so this window holds file names, not documents
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, ids`` (unsigned 32-bit, binary) of every document in the files."""
    def work(batches):
        for batch in batches:
            for row in batch.to_pylist():
                with open_file(row["file"], "rb") as source:
                    held, size = [], 0
                    for doc_id, start, ids in Reader(source).documents():
                        held.append({"doc_id": doc_id, "start": row["base"] + start, "ids": ids.tobytes()})
                        size += ids.nbytes
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held, size = [], 0
                    if held:
                        yield pa.RecordBatch.from_pylist(held, schema)

    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])
    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (manifest.select("file", "base").repartition(tasks, "file")
            .mapInArrow(work, "doc_id long, start long, ids binary"))


def read_documents(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, as read from the files."""
    return read(manifest).select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                                 F.crc32("ids").alias("ids_crc32"))


def vocabulary_size(tokenizer_path: str) -> int:
    """Ids that the tokenizer file can give, added tokens included."""
    with open(tokenizer_path, encoding="utf-8") as file:
        spec = json.load(file)
    return 1 + max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])


def write_and_read(spark: SparkSession, df: DataFrame, path: str, tokenizer_path: str, end_id: int) -> DataFrame:
    return read_documents(write(df, path, tokenizer_path, vocabulary_size(tokenizer_path), end_id))
