"""Cross-tokenizer alignment: byte groups and links between the tokens of two tokenizers.

Each text, with a space put before it, is cut by a byte-level BPE (A, a ``tokenizers`` file) and by
a piece model (B, a ``sentencepiece`` file, which puts that space there itself). Where a token of A
and one of B end at the same byte a group ends; an A token and a B token are linked where their
bytes overlap. A pair of ids counts the documents of the whole corpus that hold it linked.

**Coarse cuts, then bytes.** Token ends come from the libraries' own spans: character offsets for
A, byte spans of the proto for B. They are exact wherever tokens end between characters. Tokens
that end inside a character (several tokens then name the same character, and the pieces of a byte
fallback all but the last an empty span) are placed by the lengths of their decoded bytes from the
last certain end. The joined bytes of both are compared with the text; where either differs, the
text has no tokens here.

**Units.** A space between two characters that are not white space begins a new match of A's
pattern, and in B's vocabulary (checked when it is loaded) no piece has a word mark behind another
character. So both tokenizers cut there, and a text is aligned word by word: each distinct word
once for many texts, kept in a bounded memo.

**Counting without moving links.** Tasks pack texts into *slices*: distinct words with their links
as numbers into the slice's list of distinct id pairs, texts as numbers into the list of words, and
for each pair in how many texts of the slice it occurs. Only the pairs of slices are shuffled: to be
summed, to find each A id's highest count, and to bring the sums back to their slices, which then
give every text its figures, one slice at a time. A pair that stands in a third of all texts is one
row a slice.

Nulls: a NULL or empty text has no tokens: zeros, and the empty string in place of the digest.
Each row is a document of its own, also where ids are NULL or repeat. An empty table gives an
empty result. A single word is aligned in one piece, whatever its length.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from logonlens.llm.byte_bpe import give_back, rarer_gc
from logonlens.llm.common import cut, document_rows, split_at_spaces

MARK = "▁"
SLICE_UNITS = 1 << 20        # words of the texts of a slice, about
SLICE_DISTINCT = 1 << 17     # distinct words of a slice, about
MEMO_UNITS = 1 << 18         # cut words that a worker keeps
MEMO_CHARS = 64              # longer words are not kept
TOGETHER = 8192              # words cut by one call, at most
ALIGNED_TOGETHER = 16_384    # words aligned at once
LINE_UNITS = 64              # words of a line that the libraries get
TOGETHER_CHARS = 1 << 20     # and their characters, about
TEXTS_TOGETHER = 256         # texts whose pairs are made distinct at once
B_BITS = 20                  # bits of a B id in a packed pair
# A slice has megabytes. Parquet's writer looks at its buffers after the first 100 rows, and its reader takes up to
# 4,096 rows of a row group at once; a task of a large input has a hundred slices. So each is a row group.
ROW_GROUPS = {"parquet.block.row.count.limit": "1"}


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges (start, size), one after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def _distinct(values: np.ndarray) -> np.ndarray:
    """The different ones of ``values``, ascending; sorts them in place."""
    values.sort()
    new = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    return values[new]


def _running(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Running sums of ``values`` that start anew after each of ``sizes`` entries."""
    total = np.cumsum(values)
    first = np.cumsum(sizes) - sizes
    return total - np.repeat(np.r_[0, total][first], sizes)


class Cutter:
    """Cuts words into the tokens of both tokenizers. A word's record is a row of int32: numbers of
    tokens of A and of B, then ids and byte ends of A's tokens and of B's; it has no tokens where
    the bytes of either are not those of the word."""

    def __init__(self, a_path: str, b_path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")       # a task has one core
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True              # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        with open(a_path, encoding="utf-8") as f:
            model = json.load(f)["model"]["vocab"]
        byte_of = _byte_letters()
        self.a_bytes = [b""] * (max(model.values()) + 1)
        for entry, i in model.items():
            if all(c in byte_of for c in entry):
                self.a_bytes[i] = bytes(byte_of[c] for c in entry)
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                self.b_bytes.append(bytes([int(piece[3:5], 16)]))
            elif MARK in piece.lstrip(MARK):
                raise ValueError(f"piece {piece!r} has a word mark behind another character: texts cannot be cut at spaces")
            else:
                self.b_bytes.append(piece.replace(MARK, " ").encode())
        if len(self.b_bytes) > 1 << B_BITS:
            raise ValueError(f"more than 2 ** {B_BITS} pieces")
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        # a group is written as its ids of A, a bar, its ids of B, and a semicolon behind it
        ends = [[str(i).encode() + mark for i in range(len(t))] for t, mark in (
            (self.a_bytes, b","), (self.a_bytes, b"|"), (self.b_bytes, b","), (self.b_bytes, b";"))]
        self.written = np.array([x for t in ends for x in t], object)
        self.written_size = np.array([len(x) for x in self.written], np.int64)

    def cut(self, units: list[str]) -> list[bytes]:
        """The record of every unit, as it stands behind a space. Units without white space at
        their ends are joined by spaces into lines, since both tokenizers cut there again."""
        joined = [k for k, u in enumerate(units) if u and not u[0].isspace() and not u[-1].isspace()]
        alone = sorted(set(range(len(units))) - set(joined))
        lines = [joined[at:at + LINE_UNITS] for at in range(0, len(joined), LINE_UNITS)] + [[k] for k in alone]
        out: list[bytes] = [b""] * len(units)
        while lines:
            done = self._cut_lines([[units[k] for k in line] for line in lines])
            again = []
            for line, records in zip(lines, done, strict=True):
                if records is None and len(line) > 1:
                    again += [[k] for k in line]
                else:
                    for k, record in zip(line, records or [_NO_TOKENS], strict=True):
                        out[k] = record
            lines = again
        return out

    def _cut_lines(self, lines: list[list[str]]) -> list[list[bytes] | None]:
        """The records of the units of every line; None where the bytes of either tokenizer are not
        those of the line, or a token reaches over a unit's end."""
        texts = [" ".join(line) for line in lines]
        spaced = [" " + t for t in texts]
        of_a = self.a.encode_batch(spaced, add_special_tokens=False)
        of_b = self.b.encode(texts, out_type="proto", num_threads=1)
        text = "".join(spaced)
        whole = text.encode()
        # the byte at which every character begins
        if len(whole) == len(text):
            at_byte = np.arange(len(text) + 1)
        else:
            code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            at_byte = np.r_[0, np.cumsum(1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000))]
        n_units = np.fromiter(map(len, lines), np.int64, len(lines))
        unit_end = at_byte[np.cumsum(np.fromiter((len(u) + 1 for line in lines for u in line), np.int64, n_units.sum()))]
        unit_base = np.r_[0, unit_end[:-1]]
        chars = np.fromiter(map(len, spaced), np.int64, len(lines))
        char_base = np.cumsum(chars) - chars
        base = at_byte[char_base]

        n_a = np.fromiter((len(x) for x in of_a), np.int64, len(lines))
        ids_a = np.fromiter(chain.from_iterable(x.ids for x in of_a), np.int64, n_a.sum())
        spans = np.fromiter(chain.from_iterable(chain.from_iterable(x.offsets for x in of_a)), np.int64, 2 * n_a.sum())
        begin, end = spans[::2], spans[1::2]
        by_bytes = _running(self.a_size[ids_a], n_a)
        # a token ends between characters unless the next one begins in the same character
        last = np.zeros(len(ids_a), bool)
        last[np.cumsum(n_a)[n_a > 0] - 1] = True
        sure = last | (np.r_[begin[1:], 0] == end)
        ends_a = np.where(sure, at_byte[np.repeat(char_base, n_a) + end], np.repeat(base, n_a) + by_bytes)

        n_b = np.fromiter((len(x.pieces) for x in of_b), np.int64, len(lines))
        ids_ends = np.fromiter(chain.from_iterable((p.id, p.end) for x in of_b for p in x.pieces), np.int64, 2 * n_b.sum())
        ids_b, span_end = ids_ends[::2], ids_ends[1::2] + 1       # the library's own space
        size_b = self.b_size[ids_b]
        by_bytes = _running(size_b, n_b)
        # the span of a byte of a fallback does not move until its last one
        moved = span_end - (by_bytes - size_b) == size_b
        ends_b = np.repeat(base, n_b) + np.where(moved, span_end, by_bytes)

        line_of = np.repeat(np.arange(len(lines)), n_units)
        right = self._right(ids_a, n_a, self.a_bytes, whole, np.r_[base, len(whole)]) \
            & self._right(ids_b, n_b, self.b_bytes, whole, np.r_[base, len(whole)])
        counts = []
        if right.all():                      # ends ascend, so tokens can be told off to their units
            for ends in (ends_a, ends_b):
                upto = np.searchsorted(ends, unit_end, "right")
                right[line_of[ends[np.maximum(upto, 1) - 1] != unit_end]] = False
                counts.append(np.diff(upto, prepend=0))
        if not right.all():
            if len(lines) == 1:
                return [None]
            return [self._cut_lines([line])[0] for line in lines]
        n_a, n_b = counts
        sizes = 2 + 2 * (n_a + n_b)
        first = np.cumsum(sizes) - sizes
        flat = np.zeros(sizes.sum(), np.int32)
        flat[first], flat[first + 1] = n_a, n_b
        for values, at, n in ((ids_a, first + 2, n_a), (ends_a - np.repeat(unit_base, n_a), first + 2 + n_a, n_a),
                              (ids_b, first + 2 + 2 * n_a, n_b), (ends_b - np.repeat(unit_base, n_b), first + 2 + 2 * n_a + n_b, n_b)):
            flat[_ranges(at, n)] = values
        data, edges = flat.tobytes(), (4 * np.r_[first, sizes.sum()]).tolist()
        records = iter([data[x:y] for x, y in zip(edges[:-1], edges[1:], strict=True)])
        return [list(islice(records, n)) for n in n_units.tolist()]

    @staticmethod
    def _right(ids: np.ndarray, n: np.ndarray, table: list[bytes], whole: bytes, edges: np.ndarray) -> np.ndarray:
        """Whether the tokens' bytes are those of their line."""
        edge, bounds, ids = np.r_[0, np.cumsum(n)].tolist(), edges.tolist(), ids.tolist()
        return np.array([b"".join(map(table.__getitem__, ids[edge[k]:edge[k + 1]])) == whole[bounds[k]:bounds[k + 1]]
                         for k in range(len(n))], bool)


_NO_TOKENS = np.zeros(2, np.int32).tobytes()


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes stand for
    themselves, the others for letters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class Aligned:
    """Many words at once: for each its numbers of tokens, groups and links (``n_a``, ``n_b``,
    ``n_groups``, ``n_links``), its groups as text (``groups``, each ended by a semicolon), and in
    ``pairs`` the packed id pairs of all links, word by word."""

    def __init__(self, records: list[bytes], cutter: Cutter) -> None:
        parts = [self._part(records[at:at + ALIGNED_TOGETHER], cutter) for at in range(0, max(1, len(records)), ALIGNED_TOGETHER)]
        *figures, groups = zip(*parts, strict=True)
        self.n_a, self.n_b, self.n_groups, self.n_links, self.pairs = map(np.concatenate, figures)
        self.groups = list(chain.from_iterable(groups))

    @staticmethod
    def _part(records: list[bytes], cutter: Cutter) -> tuple:
        """``n_a, n_b, n_groups, n_links, pairs, groups`` of some of the words."""
        flat = np.frombuffer(b"".join(records), np.int32).astype(np.int64)
        sizes = np.fromiter(map(len, records), np.int64, len(records)) // 4
        first = np.cumsum(sizes) - sizes
        n_a, n_b = flat[first], flat[first + 1]
        ids_a, ids_b = flat[_ranges(first + 2, n_a)], flat[_ranges(first + 2 + 2 * n_a, n_b)]
        rel_a, rel_b = flat[_ranges(first + 2 + n_a, n_a)], flat[_ranges(first + 2 + 2 * n_a + n_b, n_b)]
        # all words on one line of bytes; both rows of tokens end at each word's end
        size = np.zeros(len(records), np.int64)
        size[n_a > 0] = rel_a[np.cumsum(n_a)[n_a > 0] - 1]
        base = np.cumsum(size) - size
        word_a, word_b = np.repeat(np.arange(len(records)), n_a), np.repeat(np.arange(len(records)), n_b)
        ends_a, ends_b = base[word_a] + rel_a, base[word_b] + rel_b
        # between two neighbouring ends lies one token of each: a link
        cuts = np.union1d(ends_a, ends_b)
        a, b = np.searchsorted(ends_a, cuts), np.searchsorted(ends_b, cuts)
        pairs = ids_a[a] << B_BITS | ids_b[b]
        n_links = np.bincount(word_a[a], minlength=len(records))
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        n_groups = np.bincount(word_a[np.searchsorted(ends_a, common)], minlength=len(records))
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        last_a, last_b = np.diff(group_a, append=-1) != 0, np.diff(group_b, append=-1) != 0
        shift = len(cutter.a_bytes)
        part = np.r_[ids_a + shift * last_a, 2 * shift + ids_b + len(cutter.b_bytes) * last_b]
        order = np.argsort(np.r_[2 * group_a, 2 * group_b + 1], kind="stable")
        text = b"".join(cutter.written[part[order]].tolist())
        length = _sums(np.r_[word_a, word_b][order], cutter.written_size[part[order]], len(records))
        edge = np.r_[0, np.cumsum(length)].tolist()
        return n_a, n_b, n_groups, n_links, pairs, [text[x:y] for x, y in zip(edge[:-1], edge[1:], strict=True)]


class Memo(dict):
    """Records of words, cut many at a time."""

    def __init__(self, cutter: Cutter) -> None:
        self.cutter = cutter

    def records(self, units: list[str]) -> list[bytes]:
        out = list(map(self.get, units))
        part, chars = [], 0
        missing = [k for k, x in enumerate(out) if x is None]
        for k in missing:
            part.append(k)
            chars += len(units[k])
            if len(part) == TOGETHER or chars >= TOGETHER_CHARS or k == missing[-1]:
                for at, record in zip(part, self.cutter.cut([units[i] for i in part]), strict=True):
                    out[at] = record
                    if len(units[at]) <= MEMO_CHARS:
                        self[units[at]] = record
                part, chars = [], 0
        if len(self) > MEMO_UNITS:
            self.clear()
        return out


@lru_cache(maxsize=1)
def _memo(a_path: str, b_path: str) -> Memo:
    return Memo(Cutter(a_path, b_path))


def units_of(text: str) -> list[str]:
    """The words to align; none where the bytes of B cannot be those of the text (a word mark in
    a text is read as a space)."""
    return [] if not text or MARK in text else split_at_spaces(text)


class Numbers(dict):
    """Numbers words as they come."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


class Slice:
    """Texts as numbers into a list of distinct words."""

    def __init__(self) -> None:
        self.number = Numbers()
        self.ids: list = []
        self.texts: list[np.ndarray] = []
        self.units = 0

    def add(self, doc_id: int | None, text: str) -> None:
        own = list(map(self.number.__getitem__, units_of(text)))
        self.ids.append(doc_id)
        self.texts.append(np.array(own, np.int32))
        self.units += len(own)

    def row(self, number: int, memo: Memo) -> dict:
        words = Aligned(memo.records(list(self.number)), memo.cutter)
        broken = words.n_a == 0
        texts = [t if not broken[t].any() else t[:0] for t in self.texts]   # such a text has no tokens
        size = np.array([len(t) for t in texts], np.int64)
        every = np.concatenate(texts)
        doc = np.repeat(np.arange(len(texts)), size)
        totals = {name: _sums(doc, getattr(words, name)[every], len(texts)) for name in ("n_a", "n_b", "n_groups")}
        pairs, link = np.unique(words.pairs, return_inverse=True)
        n_links = words.n_links
        first = np.cumsum(n_links) - n_links
        held = np.zeros(len(pairs), np.int64)
        for at in range(0, len(texts), TEXTS_TOGETHER):
            # each pair of each text once: words of the text, then their pairs
            some = texts[at:at + TEXTS_TOGETHER]
            own = _distinct(np.repeat(np.arange(len(some)) << 32, size[at:at + TEXTS_TOGETHER]) | np.concatenate(some))
            of_doc, word = own >> 32, own & 0xFFFFFFFF
            pair = _distinct(np.repeat(of_doc, n_links[word]) << 32 | link[_ranges(first[word], n_links[word])])
            held += np.bincount(pair & 0xFFFFFFFF, minlength=len(pairs))
        names = words.groups
        digest = [hashlib.sha256(b"".join([names[k] for k in t.tolist()])[:-1]).hexdigest() if len(t) else "" for t in texts]
        return {"slice": number, "ids": self.ids, **totals, "digests": digest, "sizes": size, "texts": every.tobytes(),
                "n_links": n_links.astype(np.int32).tobytes(), "links": link.astype(np.int32).tobytes(), "pairs": pairs,
                "held": held}


_LONGS = pa.list_(pa.int64())
_SLICE = pa.schema([("slice", pa.int64()), ("ids", _LONGS), ("n_a", _LONGS), ("n_b", _LONGS), ("n_groups", _LONGS),
                    ("digests", pa.list_(pa.string())), ("sizes", _LONGS), ("texts", pa.binary()), ("n_links", pa.binary()),
                    ("links", pa.binary()), ("pairs", _LONGS), ("held", _LONGS)])
_SLICE_SQL = ("slice long, ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, digests array<string>, "
              "sizes array<long>, texts binary, n_links binary, links binary, pairs array<long>, held array<long>")


def write_slices(df: DataFrame, a_path: str, b_path: str, id_col: str, text_col: str) -> DataFrame:
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rarer_gc()
        memo, part, number, held = _memo(a_path, b_path), TaskContext.get().partitionId(), 0, Slice()
        for batch in batches:
            texts = batch.column(1)
            for doc_id, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                held.add(doc_id, text.as_py())
                if held.units >= SLICE_UNITS or len(held.number) >= SLICE_DISTINCT:
                    yield pa.RecordBatch.from_pylist([held.row(part << 32 | number, memo)], _SLICE)
                    held, number = Slice(), number + 1
        if held.ids:
            yield pa.RecordBatch.from_pylist([held.row(part << 32 | number, memo)], _SLICE)
        del held
        give_back()

    return cut(document_rows(df, id_col, text_col).mapInArrow(work, _SLICE_SQL), "aligned-slices", options=ROW_GROUPS)


def pair_counts(slices: DataFrame) -> DataFrame:
    """``pair, n`` (documents that hold it linked) and ``best``: no pair of its A id has more."""
    counted = cut(slices.select(F.inline(F.zip_with("pairs", "held", lambda p, n: F.struct(p.alias("pair"), n.alias("n")))))
                  .groupBy("pair").agg(F.sum("n").alias("n")), "aligned-pairs")
    of_a = F.shiftright("pair", B_BITS)
    most = counted.groupBy(of_a.alias("a")).agg(F.max("n").alias("most"))
    return counted.join(most, of_a == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def alignment_figures(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row of ``df``."""
    slices = write_slices(df, a_path, b_path, id_col, text_col)
    placed = slices.select("slice", F.posexplode("pairs").alias("at", "pair"))
    back = placed.join(pair_counts(slices), "pair").select(F.col("slice").alias("s"), "at", "n", "best")

    def work(slice_: pa.Table, sums: pa.Table) -> pa.Table:
        row = {name: slice_.column(name)[0] for name in slice_.column_names}
        longs = {name: row[name].values.to_numpy() for name in ("n_a", "n_b", "n_groups", "sizes")}
        texts, n_links, links = (np.frombuffer(row[name].as_buffer(), np.int32) for name in ("texts", "n_links", "links"))
        order = np.argsort(sums.column("at").to_numpy())
        count, best = (sums.column(name).to_numpy()[order] for name in ("n", "best"))
        word = np.repeat(np.arange(len(n_links)), n_links)
        of_word = [n_links.astype(np.int64), _sums(word, best[links].astype(np.int64), len(n_links)),
                   _sums(word, count[links], len(n_links))]
        doc = np.repeat(np.arange(len(longs["sizes"])), longs["sizes"])
        figures = [_sums(doc, x[texts], len(longs["sizes"])) for x in of_word]
        return pa.Table.from_arrays(
            [row["ids"].values, *(pa.array(longs[name]) for name in ("n_a", "n_b", "n_groups")),
             *map(pa.array, figures), row["digests"].values],
            ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    needed = ["slice", "ids", "n_a", "n_b", "n_groups", "digests", "sizes", "texts", "n_links", "links"]
    return slices.select(*needed).groupBy("slice").cogroup(back.groupBy("s")).applyInArrow(
        work, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
              "groups_sha256 string")


def _sums(of: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Exact sums of ``values`` by ``of`` (ascending)."""
    total = np.r_[0, np.cumsum(values, dtype=np.int64)]
    edge = np.searchsorted(of, np.arange(size + 1))
    return total[edge[1:]] - total[edge[:-1]]


def aligned_groups(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, groups`` for every row of ``df``: its groups in order, each with the ids of A
    (``a``) and of B (``b``) in it. A text without tokens has none."""
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rarer_gc()
        memo, schema = _memo(a_path, b_path), pa.schema([("doc_id", pa.int64()), ("groups", pa.list_(
            pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))])))])
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                units = units_of(text.as_py())
                words = Aligned(memo.records(units), memo.cutter)
                parts = [g.split("|") for g in b"".join(words.groups).decode().split(";") if g] if (words.n_a > 0).all() else []
                yield pa.RecordBatch.from_pylist([{"doc_id": doc_id, "groups": [
                    {"a": [int(i) for i in a.split(",")], "b": [int(i) for i in b.split(",")]} for a, b in parts]}], schema)

    return document_rows(df, id_col, text_col).mapInArrow(
        work, "doc_id long, groups array<struct<a: array<int>, b: array<int>>>")
