"""Suffix-array dedup against brute force over all strings."""
import hashlib
import random

import numpy as np
import pytest
from llm_data import edge_docs, no_docs, SMALL, texts_of  # noqa: F401

from logonlens.llm import suffix_dedup
from logonlens.llm.queries import QUERIES


def plain(docs, length):
    """(doc_id, bytes) in order -> rows; a string counts as earlier if seen before."""
    seen, out = set(), []
    for i, t in docs:
        gone = bytearray(len(t))
        for s in range(len(t) - length + 1):
            key = t[s:s + length]
            if key in seen:
                gone[s:s + length] = b"\1" * length
            seen.add(key)
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(t)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def ordered(spark, df):
    """Rows in the operator's document order; rows equal in id and text once."""
    from pyspark.sql import functions as F

    rows = df.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).distinct() \
        .withColumn("h", F.xxhash64("text")).collect()
    rows.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h))
    return [(r.doc_id, r.text.encode()) for r in rows]


def same(spark, df, length):
    got = suffix_dedup.digests(df, length).distinct().collect()
    assert sorted(map(tuple, got), key=str) == plain(ordered(spark, df), length)


def test_query_on_the_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = QUERIES["op9_suffix_dedup"](spark, SMALL)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(ordered(spark, docs), 100)


def plain_starts(texts, length):
    seen, out = set(), set()
    for k, t in enumerate(texts):
        for s in range(len(t) - length + 1):
            out |= {(k, s)} if t[s:s + length] in seen else set()
            seen.add(t[s:s + length])
    return out


def in_one_slice(texts, length, batch_bytes):
    """Lost starts by the operator's own steps, without Spark."""
    before, suffix_dedup.BATCH_BYTES = suffix_dedup.BATCH_BYTES, batch_bytes
    found = suffix_dedup.Segments(texts, length)
    blobs = [texts[t][s:s + c + length - 1] for t, s, c in zip(found.text, found.start, found.count, strict=True)]
    first = np.empty(len(blobs), np.int64)
    first[np.lexsort((found.start, found.text))] = np.arange(len(blobs))
    earliest, lost = suffix_dedup.judge(found.anchor, found.digests(texts, length), first, found.count, found.offset,
                                        blobs, length)
    suffix_dedup.BATCH_BYTES = before
    out = set()
    for i in range(len(blobs)):
        for k in range(found.count[i]):
            if not earliest[i] or lost[i] is not None and lost[i][k]:
                out.add((int(found.text[i]), int(found.start[i] + k)))
    return out


@pytest.mark.parametrize("length", [33, 100])
def test_shared_passages_periods_and_overlaps(spark, length):
    rnd = random.Random(length)
    base = "".join(rnd.choice("abcd é") for _ in range(600))
    texts = ["x" * 260, "ab" * 150, base, base[50:330] + "|" + base[100:420], base[:length - 1], base[:length],
             base[5:5 + length] + base[5:5 + length], "abc" * 60 + base[200:200 + length] + "x" * 120, "y" + "x" * 300]
    for _ in range(25):
        a, n = rnd.randrange(500), rnd.randrange(10, 250)
        cut = base[a:a + n]
        k = rnd.randrange(len(cut) + 1)
        texts.append(cut[:k] + rnd.choice(["", "#", "##"]) + cut[k:] + rnd.choice(["", base[:90], "x" * 50]))
    rnd.shuffle(texts)
    data = [t.encode() for t in texts]
    for batch in (200, 2000, 1 << 20):      # by parts, in several batches, at once
        assert in_one_slice(data, length, batch) == plain_starts(data, length)
    same(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3), length)


def test_edge_cases(spark, edge_docs, no_docs):
    same(spark, edge_docs, 100)
    same(spark, edge_docs, 40)
    assert suffix_dedup.digests(no_docs).count() == 0


def test_runs_of_the_transform_equal_brute_force():
    rnd = random.Random(3)
    for _ in range(60):
        segments = list({bytes(rnd.choice(b"ab") for _ in range(rnd.randrange(1, 30))) for _ in range(rnd.randrange(1, 12))})
        length = rnd.randrange(1, 8)
        want = {}
        for k, s in enumerate(segments):
            for o in range(len(s) - length + 1):
                want.setdefault(s[o:o + length], []).append((k, o))
        runs = {}
        for r, w, o in zip(*suffix_dedup.shared_runs(segments, length), strict=True):
            runs.setdefault(int(r), []).append((int(w), int(o)))
        got = [sorted(v) for v in runs.values()]
        assert sorted(got) == sorted(sorted(v) for v in want.values() if len(v) > 1)


def test_anchor_depends_on_the_string_alone():
    rnd = random.Random(5)
    data = bytes(rnd.choice(b"ab") for _ in range(3000))
    found = suffix_dedup.Segments([data], 50)
    anchor = {}
    for s, c, o, h in zip(found.start, found.count, found.offset, found.anchor, strict=True):
        for k in range(c):
            key = data[s + k:s + k + 50]
            assert anchor.setdefault(key, (o - k, h)) == (o - k, h)
    assert int(np.sum(found.count)) == len(data) - 49


def passages(n, rnd):
    """Texts that share two passages among bytes of their own, some of which are alike."""
    shared = ["".join(rnd.choice("abcdefgh ") for _ in range(300)) for _ in range(2)]
    out = []
    for i in range(n):
        edge = rnd.choice(["", "x", "xy", "the same edge "])
        out.append("".join(rnd.choice("klmno") for _ in range(rnd.randrange(0, 150))) + edge + shared[i % 5 == 0]
                   + rnd.choice(["", "z", edge]) + "".join(rnd.choice("pqrs") for _ in range(rnd.randrange(0, 150))))
    return out


@pytest.mark.parametrize(("hot", "very_hot"), [(2, 1 << 40), (2, 2), (5, 30), (1 << 40, 1 << 40)])
def test_segments_of_hot_anchors_are_cut(spark, monkeypatch, hot, very_hot):
    monkeypatch.setattr(suffix_dedup, "HOT_PLACES", hot)
    monkeypatch.setattr(suffix_dedup, "VERY_HOT_PLACES", very_hot)
    monkeypatch.setattr(suffix_dedup, "SLICE_BYTES", 1500)
    texts = passages(60, random.Random(hot)) + ["x" * 400, "ab" * 200]
    same(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4), 100)


def test_parts_hold_every_start_once_and_depend_on_their_strings_alone():
    rnd = random.Random(8)
    texts = [t.encode() for t in passages(20, rnd)]
    found = suffix_dedup.Segments(texts, 100)
    anchors = np.unique(found.anchor)[::2]
    for step in (1, 8, 100):
        parts = found.split(anchors, np.full(len(anchors), step), texts, 100)
        starts = sorted((int(t), int(b) + k) for t, b, c in zip(parts.text, parts.start, parts.count, strict=True) for k in range(c))
        assert starts == sorted((k, s) for k, t in enumerate(texts) for s in range(len(t) - 99))
        key, cut = {}, 0
        for t, b, c, o, a in zip(parts.text, parts.start, parts.count, parts.offset, parts.anchor, strict=True):
            assert 0 <= o and (c <= step or a in set(found.anchor))
            for k in range(c):
                assert key.setdefault(texts[t][b + k:b + k + 100], (a, o - k)) == (a, o - k)
            cut += a not in found.anchor
        assert cut > 0


def test_a_hot_passage_brings_few_differing_parts_to_one_anchor():
    """One passage in every text, among bytes that differ: the anchors at its ends have as many
    different segments as there are texts, the starts of a very hot anchor none that differ."""
    rnd = random.Random(2)
    shared = "".join(rnd.choice("abcdefgh ") for _ in range(150))
    texts = [("".join(rnd.choice("klmnopqrstuv") for _ in range(120)) + shared
              + "".join(rnd.choice("klmnopqrstuv") for _ in range(120))).encode() for _ in range(400)]
    found = suffix_dedup.Segments(texts, 100)

    def differing(parts):
        kinds = {}
        for a, d in zip(parts.anchor.tolist(), parts.digests(texts, 100).tolist(), strict=True):
            kinds.setdefault(a, set()).add(d)
        return max(map(len, kinds.values()))

    hot, n = np.unique(found.anchor, return_counts=True)
    hot = hot[n > 50]
    eight, one = np.full(len(hot), 8), np.full(len(hot), 1)
    assert len(hot) and differing(found) > 350
    single = found.split(hot, one, texts, 100)
    single = single.take(np.flatnonzero(~np.isin(single.anchor, found.anchor)))
    assert len(single.text) and differing(single) == 1
    # parts of eight starts: fewer bytes of their own, and only parts over an end differ
    parts = found.split(hot, eight, texts, 100)
    assert (parts.count + 99)[np.isin(parts.anchor, hot, invert=True) & ~np.isin(parts.anchor, found.anchor)].max() <= 107


def test_ranges_are_even():
    """Although anchors are the smallest hashes of their windows."""
    rnd = random.Random(12)
    data = bytes(rnd.choice(b"abcdefghijklmnop ") for _ in range(600_000))
    anchors = np.unique(suffix_dedup.Segments([data], 100).anchor)
    sizes = sorted(len(at) for _, at in suffix_dedup._by_range(anchors, 64))
    assert len(sizes) == 64 and sizes[-1] < 1.5 * sizes[32] and sum(sizes) == len(anchors)
