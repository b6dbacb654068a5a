"""Phrase collocations per language, counted in counting quotient filters.

Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line breaks, and pieces into words.
Phrases of two to ``LONGEST`` words that occur at least ``min_count`` times within pieces are
candidates; a candidate's score is ``floor(2000000 * a / (l + r))`` over its weakest cut into two
parts that occur ``l`` and ``r`` times. A candidate inside a longer one that covers at least
``COVERED_PERCENT`` of its occurrences is dropped, and each language's best are returned.

**Word ids.** Tasks pack the words of many texts of a language into *slices*: a list of distinct
words, their counts, and the texts as numbers into that list. Only the distinct words of slices are
shuffled, to be counted and numbered; a phrase can only be frequent if its words are, so just those
get ids. The ids go back to the slices; no word occurrence is ever a row of its own.

**Counting quotient filters.** A phrase is its word ids packed into one number, of a width that all
phrases of its length share. A Feistel network, which can be inverted, permutes these numbers; the top
bits are the quotient, all other bits the remainder. A filter keeps entries in order of (quotient,
remainder): run lengths of the quotients in unary, remainders in full, and counters that take a bit
where they are one, else a byte, with an escape. Nothing is lost, so counts are exact and phrases are read back by the inverse. The
permutation spreads all phrases evenly, so ranges of quotients make even parts however skewed the
words are: a phrase that stands in a third of all texts is one entry in each task's filter. Filters
of one part are merged by order, and entries below ``min_count`` leave there.

Scores and drops are joins of candidates in SQL, with decimals of 38 digits.

Nulls: a NULL text is empty, a NULL language is ``und``. Repeated rows count again. Languages
without candidates give no row; an empty table gives an empty result. Words are bytes, so any text
is taken; one of any length is read in chunks.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logonlens.llm.byte_bpe import give_back, rarer_gc
from logonlens.llm.common import cut

LONGEST = 4
MIN_COUNT = 30
COVERED_PERCENT = 80
TOP = 2000
NO_LANGUAGE = "und"

SLICE_WORDS = 1 << 19        # word occurrences of a slice, about (a longer text is a slice of its own)
SLICE_DISTINCT = 1 << 18     # distinct words of the slices that a task has open
CHUNK_BYTES = 1 << 20        # text that is split into words at once
FILTER_ENTRIES = 1 << 21     # entries of a task's filter before it is handed on
PART_OCCURRENCES = 1 << 20   # phrase occurrences of one length in a part, about
BUCKETS_PER_PARTITION = 4

_BREAK = b"\xff"             # not in UTF-8; stands for the end of a piece
_LETTERS = bytes(k + 32 if 65 <= k <= 90 else 255 if k in b".,;:!?\n\x0b\x0c\r" else 32 if k == 9 else k for k in range(256))


# ------------------------------------------------------------------ slices of numbered words

class OpenSlice:
    """Texts of one language as numbers into the list of their distinct words (0: a break)."""

    def __init__(self) -> None:
        self.number: defaultdict[bytes, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.number[_BREAK]
        self.waiting: list[bytes] = []
        self.bytes = 0
        self.ids: list[np.ndarray] = []
        self.words = 0

    def add(self, text: bytes) -> None:
        self.waiting += [text, _BREAK]
        self.bytes += len(text)
        if self.bytes >= CHUNK_BYTES:
            self.drain()

    def drain(self) -> None:
        data = b"".join(self.waiting).translate(_LETTERS).replace(_BREAK, b" \xff ")
        self.waiting, self.bytes = [], 0
        at = 0
        while at < len(data):
            until = data.find(b" ", at + CHUNK_BYTES) if at + CHUNK_BYTES < len(data) else len(data)
            words = data[at:until if until >= 0 else len(data)].split()
            self.ids.append(np.fromiter(map(self.number.__getitem__, words), np.int32, len(words)))
            self.words += len(words)
            at = until if until >= 0 else len(data)

    def row(self, number: int, lang: str) -> dict:
        self.drain()
        ids = np.concatenate(self.ids) if self.ids else np.zeros(0, np.int32)
        counts = np.bincount(ids, minlength=len(self.number))[1:]
        return {"slice": number, "lang": lang, "n_words": int(counts.sum()), "ids": ids.tobytes(),
                "words": list(self.number)[1:], "counts": counts}


def write_slices(df: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """``slice, lang, n_words, ids, words, counts``: every text once."""
    schema = pa.schema([("slice", pa.int64()), ("lang", pa.string()), ("n_words", pa.int64()), ("ids", pa.binary()),
                        ("words", pa.list_(pa.binary())), ("counts", pa.list_(pa.int64()))])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rarer_gc()
        part, number = TaskContext.get().partitionId(), 0
        held: dict[str, OpenSlice] = {}

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal number
            for lang, open_slice in held.items():
                yield pa.RecordBatch.from_pylist([open_slice.row(part << 32 | number, lang)], schema)
                number += 1
            held.clear()

        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1)
            for lang, text in zip(langs, texts, strict=True):
                held.setdefault(lang, OpenSlice()).add(text.as_py())
                if not held[lang].bytes and (sum(s.words for s in held.values()) >= SLICE_WORDS
                                             or sum(len(s.number) for s in held.values()) >= SLICE_DISTINCT):
                    yield from close()
        yield from close()
        give_back()

    texts = df.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
                      F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    return cut(texts.mapInArrow(work, "slice long, lang string, n_words long, ids binary, words array<binary>, "
                                      "counts array<long>"), "phrase-slices")


def numbered_words(slices: DataFrame, min_count: int) -> DataFrame:
    """``lang, word, f, id`` (dense, from 1) of the words with at least ``min_count`` occurrences."""
    buckets = BUCKETS_PER_PARTITION * int(slices.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = slices.select("lang", F.inline(F.zip_with("words", "counts", lambda w, c: F.struct(w.alias("word"), c.alias("c"))))) \
        .groupBy("lang", "word").agg(F.sum("c").alias("f")).where(F.col("f") >= min_count)
    found = cut(found.withColumn("bucket", F.pmod(F.xxhash64("lang", "word"), F.lit(buckets))), "phrase-words")
    # a row per bucket
    before = Window.partitionBy(F.lit(1)).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    starts = found.groupBy(F.col("bucket").alias("b")).agg(F.count(F.lit(1)).alias("n")) \
        .select("b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("lang", "word"))
    return cut(found.withColumn("place", place).join(starts, F.col("bucket") == F.col("b"))
               .select("lang", "word", "f", (F.col("start") + F.col("place")).alias("id")), "phrase-ids")


# ------------------------------------------------------------------ counting quotient filters

_KEYS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)


def _round(half: np.ndarray, key: int, width: int) -> np.ndarray:
    x = (half + np.uint64(key)) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x >> np.uint64(64 - width)


def permute(left: np.ndarray, right: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """A permutation of all pairs of ``width``-bit halves."""
    for key in _KEYS:
        left, right = right, left ^ _round(right, key, width)
    return left, right


def restore(left: np.ndarray, right: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    for key in reversed(_KEYS):
        left, right = right ^ _round(left, key, width), left
    return left, right


def fold(left: np.ndarray, right: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries in order of (left, right), equal ones added up."""
    order = np.argsort(left)
    left, right, count = left[order], right[order], count[order]
    same = left[1:] == left[:-1]
    mixed = same & (right[1:] != right[:-1])
    if mixed.any():                                  # equal halves of different phrases: rare
        run = np.cumsum(np.r_[True, ~same]) - 1
        in_run = np.zeros(run[-1] + 1, bool)
        in_run[run[1:][mixed]] = True
        at = np.flatnonzero(in_run[run])
        order = at[np.lexsort((right[at], left[at]))]
        right[at], count[at] = right[order], count[order]
    start = np.flatnonzero(np.r_[True, ~same | (right[1:] != right[:-1])]) if len(left) else np.zeros(0, np.int64)
    return left[start], right[start], np.add.reduceat(count, start) if len(start) else count


class CountingQuotientFilter:
    """Exact counters of permuted numbers of ``2 * width`` bits that share their top ``prefix``
    bits. ``left`` and ``right`` are the halves, in order, each pair once."""

    def __init__(self, width: int, left: np.ndarray, right: np.ndarray, count: np.ndarray) -> None:
        self.width, self.left, self.right, self.count = width, left, right, count

    def __len__(self) -> int:
        return len(self.left)

    @classmethod
    def merged(cls, filters: list[CountingQuotientFilter]) -> CountingQuotientFilter:
        halves = [np.concatenate([getattr(f, k) for f in filters]) for k in ("left", "right", "count")]
        return cls(filters[0].width, *fold(*halves))

    def parts(self, prefix: int) -> Iterator[tuple[int, CountingQuotientFilter]]:
        """The filter cut by the top ``prefix`` bits."""
        top = (self.left >> np.uint64(self.width - prefix)).astype(np.int64)
        edges = np.flatnonzero(np.r_[True, np.diff(top) != 0, True]) if len(top) else []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            yield int(top[a]), CountingQuotientFilter(self.width, self.left[a:b], self.right[a:b], self.count[a:b])

    def pack(self, prefix: int) -> bytes:
        """Bytes: sizes, runs of quotients in unary, remainders, counters."""
        n = len(self)
        bits = min(self.width - prefix, max(1, n - 1).bit_length())
        rest = self.width - prefix - bits              # bits of the left half that are not in the quotient
        below = self.left & np.uint64((1 << (self.width - prefix)) - 1)
        quotient = (below >> np.uint64(rest)).astype(np.int64)
        unary = np.zeros(n + (1 << bits), np.uint8)
        unary[quotient + np.arange(n)] = 1
        more = self.count > 1
        extra = self.count[more] - 1
        small = np.minimum(extra, 255).astype(np.uint8)
        return b"".join([
            np.array([n, bits, len(extra)], np.int64).tobytes(), np.packbits(unary).tobytes(),
            _bytes_of(below & np.uint64((1 << rest) - 1), rest), _bytes_of(self.right, self.width),
            np.packbits(more).tobytes(), small.tobytes(), extra[small == 255].astype(np.int64).tobytes()])

    @classmethod
    def unpack(cls, data: bytes, width: int, prefix: int, top: int) -> CountingQuotientFilter:
        n, bits, n_more = (int(x) for x in np.frombuffer(data, np.int64, 3))
        rest, at = width - prefix - bits, 24
        size = n + (1 << bits)
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, -(-size // 8), at), count=size))
        at += -(-size // 8)
        quotient = (ones - np.arange(n)).astype(np.uint64)
        low, at = _read(data, at, n, rest)
        right, at = _read(data, at, n, width)
        more = np.unpackbits(np.frombuffer(data, np.uint8, -(-n // 8), at), count=n).astype(bool)
        at += -(-n // 8)
        extra = np.frombuffer(data, np.uint8, n_more, at).astype(np.int64)
        extra[extra == 255] = np.frombuffer(data, np.int64, -1, at + n_more)
        count = np.ones(n, np.int64)
        count[more] += extra
        left = (quotient << np.uint64(rest)) | low
        if prefix:
            left |= np.uint64(top << (width - prefix))
        return cls(width, left, right, count)


def _bytes_of(numbers: np.ndarray, bits: int) -> bytes:
    """The low ``bits`` of every number, in whole bytes."""
    return np.ascontiguousarray(numbers.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :-(-bits // 8)].tobytes()


def _read(data: bytes, at: int, n: int, bits: int) -> tuple[np.ndarray, int]:
    size = -(-bits // 8)
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :size] = np.frombuffer(data, np.uint8, n * size, at).reshape(n, size)
    return wide.view("<u8").reshape(-1).astype(np.uint64), at + n * size


def width_of(n: int, bits: int) -> int:
    """Bits of each half of a packed phrase of ``n`` ids."""
    return -(-n * bits // 2)


def pack_ids(ids: list[np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The halves of packed phrases, from their ids in columns; the middle one of three is split."""
    shift = np.uint64(bits)
    if len(ids) == 2:
        return ids[0], ids[1]
    if len(ids) == 4:
        return (ids[0] << shift) | ids[1], (ids[2] << shift) | ids[3]
    low = width_of(3, bits) - bits
    return ((ids[0] << np.uint64(bits - low)) | (ids[1] >> np.uint64(low)),
            ((ids[1] & np.uint64((1 << low) - 1)) << shift) | ids[2])


def unpack_ids(left: np.ndarray, right: np.ndarray, n: int, bits: int) -> list[np.ndarray]:
    shift, mask = np.uint64(bits), np.uint64((1 << bits) - 1)
    if n == 2:
        return [left, right]
    if n == 4:
        return [left >> shift, left & mask, right >> shift, right & mask]
    low = width_of(3, bits) - bits
    high = np.uint64(bits - low)
    return [left >> high, ((left & np.uint64((1 << (bits - low)) - 1)) << np.uint64(low)) | (right >> shift), right & mask]


def phrases_of(ids: np.ndarray, bits: int) -> Iterator[tuple[int, CountingQuotientFilter]]:
    """The phrases of every length in a row of ids (0: no frequent word, or a break)."""
    ids = ids.astype(np.uint64)
    start = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
    for n in range(2, LONGEST + 1):
        if n > 2:
            start = start[start + n - 1 < len(ids)]
            start = start[ids[start + n - 1] > 0]
        width = width_of(n, bits)
        halves = permute(*pack_ids([ids[start + k] for k in range(n)], bits), width)
        yield n, CountingQuotientFilter(width, *fold(*halves, np.ones(len(start), np.int64)))


def word_ids(whole: CountingQuotientFilter, n: int, bits: int) -> np.ndarray:
    """The ids of every phrase of a filter, in columns."""
    return np.stack(unpack_ids(*restore(whole.left, whole.right, whole.width), n, bits), axis=1).astype(np.int64)


def phrase_counts(slices: DataFrame, words: DataFrame, n_words: int, n_known: int, min_count: int) -> DataFrame:
    """``ids`` (array of word ids) and ``a`` of all phrases with at least ``min_count`` occurrences."""
    spark = slices.sparkSession
    bits = max(1, n_known.bit_length())
    if bits > 32:
        raise ValueError("more than 2 ** 32 frequent words")
    wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n_words // PART_OCCURRENCES)
    prefix = {n: min(width_of(n, bits), wanted.bit_length()) for n in range(2, LONGEST + 1)}

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rarer_gc()
        held: dict[int, list[CountingQuotientFilter]] = defaultdict(list)

        def packed(n: int) -> pa.RecordBatch:
            rows = [(top, part.pack(prefix[n])) for top, part in CountingQuotientFilter.merged(held.pop(n)).parts(prefix[n])]
            return pa.RecordBatch.from_arrays(
                [pa.array([n] * len(rows), pa.int32()), pa.array([t for t, _ in rows], pa.int64()),
                 pa.array([b for _, b in rows], pa.binary())], ["n", "part", "filter"])

        for batch in batches:
            for k in range(batch.num_rows):
                ids = np.frombuffer(batch.column(0)[k].as_buffer(), np.int32)
                known = batch.column(1)[k].values
                if known is None:
                    continue
                at, name = (known.field(j).to_numpy() for j in (0, 1))
                table = np.zeros(int(max(ids.max(), at.max() + 1)) + 1, np.int64)
                table[at + 1] = name                 # 0 is the break
                for n, own in phrases_of(table[ids], bits):
                    held[n].append(own)
                    if len(held[n]) > 1 and sum(map(len, held[n])) >= FILTER_ENTRIES:
                        held[n] = [CountingQuotientFilter.merged(held[n])]
                    if sum(map(len, held[n])) >= FILTER_ENTRIES:
                        yield packed(n)
        for n in list(held):
            yield packed(n)
        give_back()

    def merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        n, top = key[0].as_py(), key[1].as_py()
        whole = CountingQuotientFilter.merged([CountingQuotientFilter.unpack(x.as_py(), width_of(n, bits), prefix[n], top)
                                               for x in table.column("filter")])
        many = whole.count >= min_count
        kept = CountingQuotientFilter(whole.width, whole.left[many], whole.right[many], whole.count[many])
        ids = word_ids(kept, n, bits)
        lists = pa.ListArray.from_arrays(np.arange(0, ids.size + 1, n, dtype=np.int32), pa.array(ids.reshape(-1)))
        return pa.table({"ids": lists, "a": kept.count})

    exploded = slices.select("slice", "lang", F.posexplode("words").alias("at", "word"))
    own = exploded.join(words.select("lang", "word", "id"), ["lang", "word"]) \
        .groupBy(F.col("slice").alias("s")).agg(F.collect_list(F.struct(F.col("at").cast("long"), "id")).alias("known"))
    filters = slices.select("slice", "ids").join(own, F.col("slice") == F.col("s")).select("ids", "known") \
        .mapInArrow(count, "n int, part long, filter binary")
    return cut(filters.groupBy("n", "part").applyInArrow(merge, "ids array<long>, a long"), "phrase-counts")


# ------------------------------------------------------------------ scores

def scored(candidates: DataFrame, words: DataFrame) -> DataFrame:
    """``ids, a, l, r, score`` of all candidates, by the lowest-scoring cut."""
    counts = candidates.select(F.col("ids").alias("of"), F.col("a").alias("f")) \
        .unionByName(words.select(F.array("id").alias("of"), "f"))
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)))
    for side, part in (("l", F.slice("ids", F.lit(1), F.col("k"))),
                       ("r", F.slice("ids", F.col("k") + 1, F.size("ids") - F.col("k")))):
        cuts = cuts.withColumn("part", part).join(counts.select("of", F.col("f").alias(side)), F.col("part") == F.col("of")) \
            .drop("part", "of")
    score = F.expr("(CAST(a AS DECIMAL(20, 0)) * 2000000) div (CAST(l AS DECIMAL(20, 0)) + r)")
    lowest = cuts.withColumn("score", score).groupBy("ids", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    return lowest.select("ids", "a", "m.l", "m.r", "m.score")


def covered(candidates: DataFrame) -> DataFrame:
    """``inner, most``: phrases inside longer candidates, with the largest count of one of these."""
    def inside(n):
        return F.transform(F.sequence(F.lit(1), F.size("ids") - n + 1), lambda at: F.slice("ids", at, n))

    spans = [F.when(F.size("ids") > n, inside(n)).otherwise(F.array()) for n in range(2, LONGEST)]
    return candidates.where(F.size("ids") > 2).select("a", F.explode(F.concat(*spans)).alias("inner")) \
        .groupBy("inner").agg(F.max("a").alias("most"))


def collocations(df: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT,
                 top: int = TOP, covered_percent: int = COVERED_PERCENT) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``top`` phrases."""
    slices = write_slices(df, text_col, lang_col)
    totals = slices.groupBy("lang").agg(F.sum("n_words").alias("n"))
    words = numbered_words(slices, min_count)
    n_words, n_known = totals.agg(F.sum("n")).first()[0] or 0, words.count()
    candidates = phrase_counts(slices, words, n_words, n_known, min_count)
    kept = scored(candidates, words).join(covered(candidates), F.col("ids") == F.col("inner"), "left") \
        .where(F.col("most").isNull() | (100 * F.col("most") < covered_percent * F.col("a")))
    with_lang = kept.join(words.select(F.col("id").alias("first"), "lang"), F.get("ids", F.lit(0)) == F.col("first"))
    # ties beyond the last place stay until their words are there
    order = [F.desc("score"), F.desc("a")]
    best = with_lang.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*order))) \
        .where(F.col("place") <= top).select("ids", "lang", "a", "l", "r", "score")
    spelled = best.select("*", F.posexplode("ids").alias("at", "of")) \
        .join(words.select("id", F.col("word").cast("string").alias("word")), F.col("of") == F.col("id")) \
        .groupBy("lang", "ids", "a", "l", "r", "score") \
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    ranked = spelled.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase"))) \
        .where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
