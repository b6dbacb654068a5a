"""Suffix-array dedup: bytes covered by a string of ``length`` bytes that also starts earlier.

*Earlier* means in a smaller document (by doc_id, then by the text's hash) or further left in
the same one. Every byte covered by such a string is removed; strings are judged on the input.

**Bringing equal strings together.** Every string of ``length`` bytes has an anchor: the place
in it at which the hash of ``ANCHOR`` bytes is smallest, the leftmost of equal ones. It depends
on the string's bytes alone, so equal strings have equal anchors at equal offsets. Neighbouring
starts share anchors, so a text gives one *segment* (the bytes of all strings of one anchor) for
about every 35 bytes. The texts are packed into *slices* of a few megabytes, written once to the
shared checkpoint folder, bucketed by slice, so the three passes below read them without moving
them:

1. each slice's distinct anchor hashes are grouped by hash range: which of them occur twice;
2. slices send the segments of these, equal ones folded within the slice (so a passage that most
   documents share costs one segment a slice), grouped by hash range again, and are judged;
3. the verdicts come back to the slices and are applied to the texts.

**Judging.** Segments of one anchor that are all equal need no search: the earliest stays. Where
they differ, the Burrows-Wheeler transform of the distinct ones is searched breadth-first: from
the intervals of single bytes, backward extension visits the intervals of all strings of 1, 2,
3 ... bytes. The end of an interval of ``n`` bytes that is not yet known as a boundary parts two
suffixes whose common prefix is ``n - 1`` bytes; an interval whose end is known already is not
followed further. So common prefixes come out by increasing value, and the search stops at
``length``: suffixes not parted by then share ``length`` bytes, and each run of them is one
string, whose earliest start stays.

**Hot anchors.** Where a passage stands in very many texts, the segments at its ends differ from text
to text, and one anchor would bring as many together as there are texts. The first pass counts each
anchor's places; segments of one with over ``HOT_PLACES`` are cut, before they are sent, into parts of
``PART_STARTS`` starts at fixed places from the anchor. All strings of a part hold its middle bytes, so
strings can only be shared by parts with the same middle, and anchor, place and middle make the part's
own anchor: it goes to a range of its own, and equal parts are folded in the slice as before. With
over ``VERY_HOT_PLACES`` each start is a part, which is then equal to all others of its anchor. So no
anchor brings more than ``VERY_HOT_PLACES`` parts that differ to one task, at any size of the corpus.

Equality of segments is by 128 bits of hash (anchor and segment). Segments of one anchor that
have more bytes than a transform should hold are judged a few starts at a time (equal strings
stand at equal places from their anchor, so nothing is lost), equal parts folded first: where a
passage stands in very many texts, most parts lie inside it and are equal.

Nulls: a NULL text is the empty text; a NULL doc_id stands before all others. Rows equal in both
doc_id and text count as one document, and each gets its result. An empty table gives an empty
result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logonlens.llm.byte_bpe import give_back, giving_back, rarer_gc, slices
from logonlens.llm.common import cut, document_rows, note_scratch
from logonlens.session import scratch_path

ANCHOR = 32                   # bytes hashed for an anchor; a power of two
SLICE_BYTES = 4 << 20         # text of a slice (one longer text is a slice of its own)
CHUNK_BYTES = 1 << 20         # text whose anchors are found at once
GROUP_ANCHORS = 30_000        # anchors of a hash range, about
BATCH_BYTES = 1 << 18         # bytes of one Burrows-Wheeler transform, about
HOT_PLACES = 1 << 14          # places of an anchor in the corpus above which its segments are cut
VERY_HOT_PLACES = 1 << 18     # and above which into single starts
PART_STARTS = 8               # starts taken at once where one anchor has more bytes than that
NULL_ID = -(1 << 63)

_random = np.random.default_rng(20240501)
_BYTE_HASH = _random.integers(0, 1 << 64, 256, dtype=np.uint64)
_FACTORS = _random.integers(0, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


# ---------------------------------------------------------------- anchors and segments

def _window_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``ANCHOR`` bytes from each place, by doubling the window."""
    h, width = _BYTE_HASH[data], 1
    while width < ANCHOR:
        h = h[:-width] * _FACTORS[width.bit_length()] + h[width:]
        width *= 2
    h ^= h >> np.uint64(31)
    h *= _FACTORS[0]
    h ^= h >> np.uint64(29)
    return h


def _least_in_window(h: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest of ``h[i : i + width]`` by its highest 32 bits, the leftmost of
    equal ones."""
    value, place, have = (h >> np.uint64(32)).astype(np.uint32), np.arange(len(h), dtype=np.int32), 1

    def joined(value, place, step):
        right = value[step:] < value[:-step]
        return np.where(right, value[step:], value[:-step]), np.where(right, place[step:], place[:-step])

    while 2 * have <= width:
        value, place = joined(value, place, have)
        have *= 2
    if have < width:
        _, place = joined(value, place, width - have)
    return place


class Segments:
    """The segments of some texts: for each its text (place in the list), first start within
    it, number of starts, offset of the anchor, and the anchor's hash."""

    def __init__(self, texts: list[bytes], length: int):
        parts = list(self._parts(texts, length))
        self.text, self.start, self.count, self.offset, self.anchor = (
            np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (
            np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64),
            np.zeros(0, np.uint64))

    @staticmethod
    def _parts(texts, length):
        window, group, size = length - ANCHOR + 1, [], 0
        for k in [*(k for k, t in enumerate(texts) if len(t) >= length), None]:
            if k is None or size >= CHUNK_BYTES:
                if group:
                    lengths = np.array([len(texts[x]) for x in group])
                    ends = np.cumsum(lengths)
                    data = np.frombuffer(b"".join(texts[x] for x in group), np.uint8)
                    h = _window_hashes(data)
                    place = _least_in_window(h, window)
                    # a string must not go beyond its text
                    valid = np.ones(len(place), bool)
                    for end in ends[:-1]:
                        valid[end - length + 1:end] = False
                    starts = np.flatnonzero(valid)
                    anchors = place[starts]
                    new = np.flatnonzero(np.r_[True, (anchors[1:] != anchors[:-1]) | (np.diff(starts) != 1)])
                    first, counts = starts[new], np.diff(np.r_[new, len(starts)])
                    owner = np.searchsorted(ends, first, "right")
                    yield (np.array(group)[owner], first - (ends - lengths)[owner], counts,
                           anchors[new] - first, h[anchors[new]])
                group, size = [], 0
            if k is not None:
                group.append(k)
                size += len(texts[k])

    def take(self, which: np.ndarray) -> Segments:
        out = object.__new__(Segments)
        for name in ("text", "start", "count", "offset", "anchor"):
            setattr(out, name, getattr(self, name)[which])
        return out

    def split(self, anchors: np.ndarray, starts: np.ndarray, texts: list[bytes], length: int) -> Segments:
        """With the segments of ``anchors`` (ascending) cut into parts of so many ``starts`` each, at
        fixed places from the anchor. A part's anchor is a hash of all that its strings share."""
        if not len(anchors):
            return self
        at = np.minimum(np.searchsorted(anchors, self.anchor), len(anchors) - 1)
        cut = anchors[at] == self.anchor
        whole, own, step = self.take(np.flatnonzero(~cut)), self.take(np.flatnonzero(cut)), starts[at[cut]]
        low, high = -own.offset // step, (own.count - 1 - own.offset) // step
        n = high - low + 1
        seg = np.repeat(np.arange(len(n)), n)
        number = low[seg] + np.arange(len(seg)) - np.repeat(np.cumsum(n) - n, n)
        place, step = number * step[seg], step[seg]
        begin = np.maximum(0, place + own.offset[seg])
        end = np.minimum(own.count[seg], place + step + own.offset[seg])
        middle = own.start[seg] + own.offset[seg] + place
        digest, mask = xxhash.xxh3_64_intdigest, (1 << 64) - 1
        key = np.fromiter((digest(texts[t][m + w - 1:m + length], (a + 0x9E3779B97F4A7C15 * q) & mask) for t, m, w, a, q in zip(
            own.text[seg].tolist(), middle.tolist(), step.tolist(), own.anchor[seg].tolist(), number.tolist(), strict=True)),
            np.uint64, len(seg))
        out = object.__new__(Segments)
        for name, parts in (("text", own.text[seg]), ("start", own.start[seg] + begin), ("count", end - begin),
                            ("offset", own.offset[seg] - begin), ("anchor", key)):
            setattr(out, name, np.concatenate([getattr(whole, name), parts]))
        return out

    def digests(self, texts: list[bytes], length: int) -> np.ndarray:
        digest = xxhash.xxh3_64_intdigest
        return np.fromiter((digest(texts[t][s:s + c + length - 1], o) for t, s, c, o in zip(
            self.text.tolist(), self.start.tolist(), self.count.tolist(), self.offset.tolist(), strict=True)),
            np.uint64, len(self.text))


# ---------------------------------------------------------------- judging

def suffix_array(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by their first ``depth`` symbols at least, by prefix doubling."""
    n = len(symbols)
    # the first round sorts by as many symbols as fit into one number
    bits = int(symbols.max() + 1).bit_length()
    have = min(4, 63 // bits)
    key = np.zeros(n, np.int64)
    for k in range(have):
        key <<= bits
        key[:n - k] += symbols[k:].astype(np.int64) + 1
    order = np.argsort(key)
    key = key[order]
    rank = np.empty(n, np.int64)
    rank[order] = np.cumsum(np.r_[0, key[1:] != key[:-1]])
    while True:
        after = np.zeros(n, np.int64)
        after[:n - have] = rank[have:] + 1
        after += rank * (n + 1)
        order = np.argsort(after)
        key = after[order]
        del after
        step = np.r_[0, key[1:] != key[:-1]]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(step)
        have *= 2
        if have >= depth or step.sum() == n - 1:
            return order


def shared_runs(segments: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The places of all strings of ``length`` bytes that several places of the segments share:
    the number of the string, of the segment, and the offset in it."""
    sizes = np.array([len(s) for s in segments])
    n_seg = len(segments)
    ends = np.cumsum(sizes + 1)
    symbols = np.empty(ends[-1], np.int32)
    inside = np.ones(len(symbols), bool)
    inside[ends - 1] = False
    symbols[inside] = np.frombuffer(b"".join(segments), np.uint8).astype(np.int32) + np.int32(n_seg)
    symbols[~inside] = np.arange(n_seg)          # each segment ends with a symbol of its own
    n = len(symbols)
    order = suffix_array(symbols, length + 1)
    bwt = symbols[order - 1]
    to_left = np.empty(n, np.int64)              # where the suffix one symbol longer stands
    to_left[np.argsort(bwt, kind="stable")] = np.arange(n)

    parted = np.zeros(n + 1, bool)               # a boundary is known before this place
    parted[0] = True
    heads = symbols[order]
    low = np.flatnonzero(np.r_[True, heads[1:] != heads[:-1]])
    high = np.r_[low[1:], n]                     # intervals of all strings of one symbol
    parted[high] = True
    for _ in range(length - 1):                  # from strings of 1, 2 ... symbols to one more
        if not len(low):
            break
        width = high - low
        owner = np.repeat(np.arange(len(low)), width)
        place = np.arange(width.sum()) + np.repeat(low - np.r_[0, np.cumsum(width)[:-1]], width)
        left = bwt[place]
        real = left >= n_seg                     # strings do not go on over a segment's end
        owner, place, left = owner[real], place[real], left[real]
        if not len(place):
            break
        by = np.argsort(owner * 256 + (left - n_seg), kind="stable")
        owner, place, left = owner[by], place[by], left[by]
        new = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (left[1:] != left[:-1])])
        low = to_left[place[new]]
        high = to_left[place[np.r_[new[1:], len(place)] - 1]] + 1
        go = ~parted[high]
        low, high = low[go], high[go]
        parted[high] = True
    run = np.cumsum(parted[:n]) - 1
    shared = np.bincount(run)[run] > 1
    run, order = run[shared], order[shared]
    which = np.searchsorted(ends, order, "right")
    return run, which, order - (ends - sizes - 1)[which]


def _lose(parts: list[tuple[int, int, bytes]], first: np.ndarray, lost: list, length: int) -> None:
    """Marks the strings of each part (segment, first offset in it, bytes) that start earlier in
    another one. Strings shared by several parts go along with their segments' order, since
    segments of one anchor in one text do not overlap in their starts."""
    run, which, offset = shared_runs([data for _, _, data in parts], length)
    if not len(run):
        return
    segments = np.array([seg for seg, _, _ in parts])
    order = np.lexsort((first[segments[which]], run))
    run, which, offset = run[order], which[order], offset[order]
    late = np.r_[False, run[1:] == run[:-1]]          # all but the earliest of each run
    which, offset = which[late], offset[late]
    by = np.argsort(which, kind="stable")
    which, offset = which[by], offset[by]
    cuts = np.flatnonzero(np.r_[True, which[1:] != which[:-1]])
    for at, until in zip(cuts.tolist(), [*cuts[1:].tolist(), len(which)], strict=True):
        seg, begin, _ = parts[which[at]]
        lost[seg][begin + offset[at:until]] = True


def _lose_by_parts(group: list[int], first: np.ndarray, count: np.ndarray, offset: np.ndarray,
                   blobs: list[bytes], lost: list, length: int) -> None:
    """:func:`_lose` for one anchor with many segments, ``PART_STARTS`` starts at a time. All
    strings of a part hold the bytes between its last start and the end of its first string, so
    only parts that are equal there can share one, and are judged together."""
    lowest = -int(offset[group].max())
    highest = int((count[group] - offset[group]).max())
    for at in range(lowest, highest, PART_STARTS):
        folded: dict[tuple[int, bytes], int] = {}
        for seg in sorted(group, key=first.__getitem__):
            begin = max(0, at + int(offset[seg]))
            end = min(int(count[seg]), at + PART_STARTS + int(offset[seg]))
            if begin < end:
                key = (begin - int(offset[seg]), blobs[seg][begin:end + length - 1])
                if folded.setdefault(key, seg) != seg:
                    lost[seg][begin:end] = True
        alike: dict[bytes, list] = {}
        for (place, data), seg in folded.items():
            core = data[at + PART_STARTS - 1 - place:at + length - place]
            alike.setdefault(core, []).append((seg, place + int(offset[seg]), data))
        parts, size = [], 0
        for own in alike.values():
            if len(own) > 1:
                parts += own
                size += sum(len(data) for _, _, data in own)
                if size > BATCH_BYTES:
                    _lose(parts, first, lost, length)
                    parts, size = [], 0
        if parts:
            _lose(parts, first, lost, length)


def judge(anchor: np.ndarray, digest: np.ndarray, first: np.ndarray, count: np.ndarray, offset: np.ndarray,
          blobs: list[bytes], length: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """For segments that came from slices (``first``: rank of their first start among all of
    them): whether each is the earliest of its equals, and for these the strings that start
    earlier in another segment (flags by offset)."""
    order = np.lexsort((first, digest, anchor))
    a, d = anchor[order], digest[order]
    lead = np.r_[True, (a[1:] != a[:-1]) | (d[1:] != d[:-1])][:len(order)]
    earliest = np.zeros(len(order), bool)
    earliest[order[lead]] = True
    lost = [None] * len(order)
    distinct = order[lead]
    cuts = np.flatnonzero(np.r_[True, np.diff(anchor[distinct].astype(np.int64)) != 0][:len(distinct)])
    batch, size = [], 0
    for at, until in zip(cuts.tolist(), [*cuts[1:].tolist(), len(distinct)], strict=False):
        if until - at < 2:
            continue
        group = distinct[at:until].tolist()
        for seg in group:
            lost[seg] = np.zeros(count[seg], bool)
        own = sum(len(blobs[seg]) for seg in group)
        if own > BATCH_BYTES:
            _lose_by_parts(group, first, count, offset, blobs, lost, length)
            continue
        if size + own > BATCH_BYTES:
            _lose([(seg, 0, blobs[seg]) for seg in batch], first, lost, length)
            batch, size = [], 0
        batch += group
        size += own
    if batch:
        _lose([(seg, 0, blobs[seg]) for seg in batch], first, lost, length)
    return earliest, lost


# ---------------------------------------------------------------- the passes

def _pack(rows: dict[str, np.ndarray]) -> dict[str, bytes]:
    return {k: v.tobytes() for k, v in rows.items()}


def write_slices(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """The texts in slices (``slice, n_bytes, ids, hashes, texts``), bucketed by slice, and the
    bytes of all."""
    spark = df.sparkSession

    def work(batches):
        part, number = TaskContext.get().partitionId(), 0

        def row(held):
            return pa.RecordBatch.from_pylist([{
                "slice": part << 32 | number, "n_bytes": sum(len(t) for _, _, t in held),
                "ids": [i for i, _, _ in held], "hashes": [h for _, h, _ in held], "texts": [t for _, _, t in held],
            }], schema)

        held, size = [], 0
        for rows in slices(batches):
            for i, h, t in zip(*(rows.column(k).to_pylist() for k in range(3)), strict=True):
                if held and size + len(t) > SLICE_BYTES:
                    yield row(held)
                    held, size, number = [], 0, number + 1
                held.append((i, h, t))
                size += len(t)
        if held:
            yield row(held)

    schema = pa.schema([("slice", pa.int64()), ("n_bytes", pa.int64()), ("ids", pa.list_(pa.int64())),
                        ("hashes", pa.list_(pa.int64())), ("texts", pa.list_(pa.binary()))])
    docs = document_rows(df, id_col, text_col)
    packed = docs.select("doc_id", F.xxhash64("text").alias("h"), F.col("text").cast("binary").alias("text")).mapInArrow(
        giving_back(work), "slice long, n_bytes long, ids array<long>, hashes array<long>, texts array<binary>")
    name, path = f"slices_{uuid.uuid4().hex}", scratch_path(spark, "slices")
    note_scratch(path, name)
    packed.write.format("parquet").bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "slice") \
        .option("path", path).option("parquet.block.size", str(16 << 20)).saveAsTable(name)
    table = spark.table(name)
    return table, table.agg(F.sum("n_bytes")).first()[0] or 0


def _ranges(total_bytes: int, partitions: int) -> int:
    """Hash ranges (a power of two) that give about GROUP_ANCHORS anchors each."""
    wanted = max(partitions, total_bytes // 35 // GROUP_ANCHORS)
    return 1 << max(0, int(wanted - 1).bit_length())


def _by_range(anchor: np.ndarray, ranges: int) -> Iterator[tuple[int, np.ndarray]]:
    """Places of the anchors of each hash range. Anchors are the smallest hashes of their windows,
    so it is the highest bits of a product with all of their bits that spread them evenly."""
    if not len(anchor):
        return
    bits = ranges.bit_length() - 1
    mixed = anchor * np.uint64(0x9E3779B97F4A7C15)
    number = (mixed >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(anchor), np.int64)
    order = np.argsort(number, kind="stable")
    cuts = np.flatnonzero(np.r_[True, np.diff(number[order]) != 0])
    for at, until in zip(cuts.tolist(), [*cuts[1:].tolist(), len(order)], strict=True):
        yield int(number[order[at]]), order[at:until]


def _to_slices(answers: DataFrame, columns: list[str]) -> DataFrame:
    """One row for each slice, with the list of what came back from the hash ranges. It is the
    build side of its join, so the slices' texts stream through and are never sorted."""
    return answers.groupBy("slice").agg(F.collect_list(F.struct(*columns)).alias("answers")).hint("shuffle_hash")


def repeated_anchors(table: DataFrame, ranges: int, length: int) -> DataFrame:
    """``slice, anchors, starts``: the slice's anchor hashes that occur at two places of the corpus,
    and the starts of a part where their segments are to be cut (0: they are not)."""
    def send(batches):
        rarer_gc()
        for batch in batches:
            for row in batch.to_pylist():
                anchors, n = np.unique(Segments(row["texts"], length).anchor, return_counts=True)
                yield pa.RecordBatch.from_pylist([
                    {"range": r, "slice": row["slice"], "anchors": anchors[at].tobytes(), "places": n[at].astype(np.int64).tobytes()}
                    for r, at in _by_range(anchors, ranges)], sent)

    sent = pa.schema([("range", pa.int64()), ("slice", pa.int64()), ("anchors", pa.binary()), ("places", pa.binary())])
    answer = pa.schema([("slice", pa.int64()), ("anchors", pa.binary()), ("starts", pa.binary())])

    def find(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        each = [np.frombuffer(r["anchors"], np.uint64) for r in rows]
        _, which = np.unique(np.concatenate(each), return_inverse=True)
        places = np.bincount(which, np.frombuffer(b"".join(r["places"] for r in rows), np.int64))[which].astype(np.int64)
        starts = np.where(places > VERY_HOT_PLACES, 1, np.where(places > HOT_PLACES, PART_STARTS, 0)).astype(np.int64)
        at, out = 0, []
        for r, own in zip(rows, each, strict=True):
            here = slice(at, at + len(own))
            at += len(own)
            again = places[here] > 1
            if again.any():
                out.append({"slice": r["slice"], "anchors": own[again].tobytes(), "starts": starts[here][again].tobytes()})
        return pa.Table.from_pylist(out, answer)

    rows = table.select("slice", "texts").mapInArrow(giving_back(send), "range long, slice long, anchors binary, places binary")
    return rows.groupBy("range").applyInArrow(find, "slice long, anchors binary, starts binary")


def verdicts(table: DataFrame, repeated: DataFrame, ranges: int, length: int) -> DataFrame:
    """``slice, digests, keeps_first, text, start, count, lost``: the repeated segments of each
    slice; whether its first occurrence there is the earliest of all, and for these the strings
    lost to other segments. ``cut`` and ``starts`` say which anchors' segments were cut, and how."""
    def send(batches):
        rarer_gc()
        for batch in batches:
            for row in batch.to_pylist():
                texts = row["texts"]
                found = Segments(texts, length)
                known, starts = (np.concatenate([np.frombuffer(a[k], kind) for a in row["answers"]]) for k, kind in (
                    ("anchors", np.uint64), ("starts", np.int64)))
                found = found.take(np.flatnonzero(np.isin(found.anchor, known)))
                order = np.argsort(known)
                order = order[starts[order] > 0]
                hot, starts = known[order], starts[order]
                found = found.split(hot, starts, texts, length)
                digest = found.digests(texts, length)
                ids = np.array([NULL_ID if i is None else i for i in row["ids"]], np.int64)
                hashes = np.array(row["hashes"], np.int64)
                order = np.lexsort((found.start, hashes[found.text], ids[found.text], digest, found.anchor))
                a, d = found.anchor[order], digest[order]
                lead = np.r_[True, (a[1:] != a[:-1]) | (d[1:] != d[:-1])]
                found, digest = found.take(order[lead]), digest[order[lead]]
                out = []
                for r, at in _by_range(found.anchor, ranges):
                    s = found.take(at)
                    blobs = [texts[t][b:b + c + length - 1] for t, b, c in zip(
                        s.text.tolist(), s.start.tolist(), s.count.tolist(), strict=True)]
                    out.append({"range": r, "slice": row["slice"], "blobs": b"".join(blobs),
                                "cut": b"" if out else hot.tobytes(), "starts": b"" if out else starts.tobytes()} | _pack({
                        "anchor": s.anchor, "digest": digest[at], "id": ids[s.text], "hash": hashes[s.text],
                        "text": s.text.astype(np.int64), "start": s.start.astype(np.int64),
                        "count": s.count.astype(np.int64), "offset": s.offset.astype(np.int64)}))
                yield pa.RecordBatch.from_pylist(out, sent)

    kinds = {"anchor": np.uint64, "digest": np.uint64, "id": np.int64, "hash": np.int64, "text": np.int64,
             "start": np.int64, "count": np.int64, "offset": np.int64}
    sent = pa.schema([("range", pa.int64()), ("slice", pa.int64()), ("blobs", pa.binary()), ("cut", pa.binary()),
                      ("starts", pa.binary()), *((k, pa.binary()) for k in kinds)])
    answer = pa.schema([("slice", pa.int64()), *((k, pa.binary()) for k in (
        "digest", "keeps", "text", "start", "count", "lost", "cut", "starts"))])

    def find(group: pa.Table) -> pa.Table:
        rarer_gc()
        group = group.sort_by("slice")
        columns = {k: [np.frombuffer(x, kind) for x in group.column(k).to_pylist()] for k, kind in kinds.items()}
        v = {k: np.concatenate(x) for k, x in columns.items()}
        blobs = []
        for data, counts in zip(group.column("blobs").to_pylist(), columns["count"], strict=True):
            at = 0
            for c in counts.tolist():
                blobs.append(data[at:at + c + length - 1])
                at += c + length - 1
        first = np.empty(len(blobs), np.int64)
        order = np.lexsort((v["start"], v["hash"], v["id"]))
        new = np.r_[False, (np.diff(v["id"][order]) != 0) | (np.diff(v["hash"][order]) != 0) | (np.diff(v["start"][order]) != 0)]
        first[order] = np.cumsum(new)
        earliest, lost = judge(v["anchor"], v["digest"], first, v["count"], v["offset"], blobs, length)
        out, at = [], 0
        for number, own, hot, starts in zip(group.column("slice").to_pylist(), columns["count"], group.column("cut").to_pylist(),
                                            group.column("starts").to_pylist(), strict=True):
            here = slice(at, at + len(own))
            flags = [lost[i] if lost[i] is not None else np.zeros(v["count"][i], bool) for i in range(at, at + len(own))]
            out.append({"slice": number, "lost": np.packbits(np.concatenate(flags)).tobytes(), "cut": hot, "starts": starts} | _pack({
                "digest": v["digest"][here], "keeps": earliest[here], "text": v["text"][here],
                "start": v["start"][here], "count": v["count"][here]}))
            at += len(own)
        if group.nbytes > BATCH_BYTES << 5:
            del v, blobs, columns, lost
            give_back()
        return pa.Table.from_pylist(out, answer)

    asked = table.select("slice", "ids", "hashes", "texts").join(_to_slices(repeated, ["anchors", "starts"]), "slice")
    rows = asked.mapInArrow(giving_back(send), "range long, slice long, blobs binary, cut binary, starts binary, " + ", ".join(f"{k} binary" for k in kinds))
    # as many tasks as there are partitions, however few bytes a range has: judging is the work
    tasks = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, "range").groupBy("range").applyInArrow(
        find, "slice long, digest binary, keeps binary, text binary, start binary, count binary, lost binary, "
              "cut binary, starts binary")


def _lost_starts(texts: list[bytes], answers: list[dict], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of lost starts in a slice's texts: text, first start, number of starts."""
    def all_of(name, kind):
        return np.concatenate([np.frombuffer(a[name], kind) for a in answers])

    digest, keeps, text, start, count = (all_of(n, k) for n, k in (
        ("digest", np.uint64), ("keeps", bool), ("text", np.int64), ("start", np.int64), ("count", np.int64)))
    hot, starts = all_of("cut", np.uint64), all_of("starts", np.int64)     # ascending: from one of the answers
    lost = np.concatenate([np.unpackbits(np.frombuffer(a["lost"], np.uint8), count=int(np.frombuffer(
        a["count"], np.int64).sum())) for a in answers]).astype(bool)
    found = Segments(texts, length).split(hot, starts, texts, length)
    own = found.digests(texts, length)
    hit = np.flatnonzero(np.isin(own, digest))
    spared = set(zip(text[keeps].tolist(), start[keeps].tolist(), strict=True))
    gone = np.array([i for i in hit.tolist() if (int(found.text[i]), int(found.start[i])) not in spared], np.int64)
    single = np.flatnonzero(lost & np.repeat(keeps, count))     # starts lost in a spared segment
    owner = np.searchsorted(np.cumsum(count), single, "right")
    begin = start[owner] + single - (np.cumsum(count) - count)[owner]
    return (np.r_[found.text[gone], text[owner]], np.r_[found.start[gone], begin],
            np.r_[found.count[gone], np.ones(len(single), np.int64)])


def removed_spans(size: int, start: np.ndarray, count: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by strings that start in the given ranges."""
    cover = np.zeros(size + 1, np.int64)
    np.add.at(cover, start, 1)
    np.add.at(cover, start + count + length - 1, -1)
    covered = np.cumsum(cover[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.r_[False, covered, False].astype(np.int8)))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def remove_repeats(df: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text",
                   as_text: bool = False) -> DataFrame:
    """``doc_id, text_hash, n_bytes, n_removed, n_spans, kept`` (the remaining bytes) for every
    row of ``df``; ``text_hash`` is Spark's xxhash64 of the text. With ``as_text`` the remaining
    bytes of characters that were cut into are left out, so ``kept`` is UTF-8."""
    if length <= ANCHOR:
        raise ValueError(f"length must be over {ANCHOR} bytes")
    table, total = write_slices(df, id_col, text_col)
    ranges = _ranges(total, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    repeated = cut(repeated_anchors(table, ranges, length), "repeated-anchors")
    judged = cut(verdicts(table, repeated, ranges, length), "segment-verdicts")

    def work(batches: Iterable[pa.RecordBatch]):
        rarer_gc()
        for batch in batches:
            for row in batch.to_pylist():
                texts = row["texts"]
                spans = [[] for _ in texts]
                if row["answers"]:
                    text, start, count = _lost_starts(texts, row["answers"], length)
                    order = np.argsort(text, kind="stable")
                    cuts = np.flatnonzero(np.r_[True, np.diff(text[order]) != 0]) if len(order) else []
                    for at, until in zip(cuts, np.r_[cuts[1:], len(order)] if len(order) else [], strict=True):
                        own = order[at:until]
                        t = int(text[own[0]])
                        spans[t] = removed_spans(len(texts[t]), start[own], count[own], length)
                out = []
                for i, h, t, s in zip(row["ids"], row["hashes"], texts, spans, strict=True):
                    edges = [0, *(x for span in s for x in span), len(t)]
                    kept = b"".join(t[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                    n_kept = len(kept)
                    if as_text and s:
                        kept = kept.decode(errors="ignore").encode()
                    out.append({"doc_id": i, "text_hash": h, "n_bytes": len(t), "n_removed": len(t) - n_kept,
                                "n_spans": len(s), "kept": kept})
                yield pa.RecordBatch.from_pylist(out, result)

    result = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_bytes", pa.int64()),
                        ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])
    columns = ["digest", "keeps", "text", "start", "count", "lost", "cut", "starts"]
    return table.select("slice", "ids", "hashes", "texts").join(_to_slices(judged, columns), "slice", "left") \
        .mapInArrow(giving_back(work), "doc_id long, text_hash long, n_bytes long, n_removed long, n_spans long, kept binary")


def digests(df: DataFrame, length: int = 100) -> DataFrame:
    return remove_repeats(df, length).select("doc_id", "n_bytes", "n_removed", "n_spans",
                                             F.sha2("kept", 256).alias("kept_sha256"))
