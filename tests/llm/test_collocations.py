"""Collocations against plain Python, and the filters they are counted in."""
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import edge_docs, no_docs, SMALL  # noqa: F401
from pyspark.sql import functions as F

from logonlens.llm import collocations as c


def plain(rows, min_count, top=2000, percent=80):
    """(lang, rank, phrase, a, l, r, n, score) from every (lang, text)."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f[lang].update(tuple(w[i:i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
    out = []
    for lang in f:
        many = {p: a for p, a in f[lang].items() if len(p) > 1 and a >= min_count}
        inside = Counter()
        for p, a in many.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i:i + k]] = max(inside[p[i:i + k]], a)
        found = []
        for p, a in many.items():
            if p in inside and 100 * inside[p] >= percent * a:
                continue
            score, k = min((2000000 * a // (f[lang][p[:k]] + f[lang][p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[lang][p[:k]], f[lang][p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, r, n[lang], -s) for i, (s, a, p, left, r) in enumerate(sorted(found)[:top])]
    return sorted(out)


def result(df, **how):
    return sorted(tuple(r) for r in c.collocations(df, **how).collect())


def rows_of(df):
    return [(r.lang, r.text) for r in df.select("lang", "text").collect()]


@pytest.mark.parametrize(("min_count", "top"), [(30, 2000), (4, 50)])
def test_small_table(spark, min_count, top):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = plain(rows_of(docs), min_count, top)
    assert result(docs, min_count=min_count, top=top) == want and len(want) > 10


TIES = [("en", "b c. a b. a c. b c. a b! a c? A\tB; a\nb"), ("en", "x y z w x y z w. x y z w, q y z"), (None, "n o p. n o p. n o p"),
        ("und", "n o p; n o"), ("fr", "été à été à. ÉTÉ à été à"), ("fr", None), ("de", ""), ("de", ".;.\n"), ("es", "uno"),
        ("cs", "\x01a b \x01a b \x01a b a\x1c b a\x1c b"), ("xx", "w " * 3000)]


def test_ties_nulls_and_odd_texts(spark, edge_docs, no_docs, monkeypatch):
    docs = spark.createDataFrame([(lang, t, 1, "x") for lang, t in TIES * 2], "lang string, text string, rank int, word string")
    for chunk in (c.CHUNK_BYTES, 50):
        monkeypatch.setattr(c, "CHUNK_BYTES", chunk)
        for df in (docs, edge_docs):
            assert result(df, min_count=2) == plain(rows_of(df), 2)
    assert result(docs, min_count=2, top=1, covered_percent=101) == plain(rows_of(docs), 2, 1, 101)
    assert c.collocations(no_docs).count() == 0


def test_slices_filters_and_parts_of_any_size(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("doc_id < 60")
    want = plain(rows_of(docs), 5)
    for name, value in (("SLICE_WORDS", 300), ("SLICE_DISTINCT", 100), ("FILTER_ENTRIES", 500), ("PART_OCCURRENCES", 200)):
        monkeypatch.setattr(c, name, value)
    assert result(docs, min_count=5) == want and len(want) > 10


def test_scores_do_not_overflow(spark):
    """Counts whose products pass 64 bits."""
    candidates = spark.createDataFrame([([1, 2], 9 * 10 ** 15)], "ids array<long>, a long")
    words = spark.createDataFrame([(1, 9 * 10 ** 15 + 1), (2, 9 * 10 ** 15)], "id long, f long")
    row = c.scored(candidates, words).first()
    assert (row.l, row.r, row.score) == (9 * 10 ** 15 + 1, 9 * 10 ** 15, 2000000 * 9 * 10 ** 15 // (18 * 10 ** 15 + 1))


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 32), st.integers(2, 4), st.lists(st.tuples(*[st.integers(0, (1 << 32) - 1)] * 4, st.integers(1, 700)),
                                                       min_size=1, max_size=60), st.data())
def test_filters_lose_nothing(bits, n, rows, data):
    """Permuting, folding, cutting into parts, packing, merging and restoring."""
    mask, width = (1 << bits) - 1, c.width_of(n, bits)
    rows = [(*(x & mask for x in r[:n]), r[4]) for r in rows]
    want = Counter()
    prefix = data.draw(st.integers(0, min(width, 12)))
    filters = defaultdict(list)
    for some in (rows[::2], rows[1::2], rows[:1]):
        if not some:
            continue
        for *ids, times in some:
            want[tuple(ids)] += times
        left, right = c.permute(*c.pack_ids(list(np.array([r[:n] for r in some], np.uint64).T), bits), width)
        assert width == 64 or not ((left | right) >> np.uint64(width)).any()
        whole = c.CountingQuotientFilter(width, *c.fold(left, right, np.array([r[n] for r in some], np.int64)))
        for top, part in whole.parts(prefix) if prefix else [(0, whole)]:
            filters[top].append(c.CountingQuotientFilter.unpack(part.pack(prefix), width, prefix, top))
    got = Counter()
    for group in filters.values():
        merged = c.CountingQuotientFilter.merged(group)
        assert (np.lexsort((merged.right, merged.left)) == np.arange(len(merged))).all()
        for ids, times in zip(c.word_ids(merged, n, bits).tolist(), merged.count.tolist(), strict=True):
            assert tuple(ids) not in got
            got[tuple(ids)] = times
    assert got == want


def test_parts_are_even_under_skew(spark):
    """One phrase that stands everywhere is one entry a task, whatever its count."""
    text = " ".join(["of the"] * 2000)
    docs = spark.createDataFrame([("en", f"{text} w{i % 50} of the x{i % 60}") for i in range(200)], "lang string, text string")
    got = {r.phrase: r.a for r in c.collocations(docs, min_count=3, covered_percent=200).collect()}
    assert got["of the"] == 200 * 2001 and got["the of the of"] == 200 * 1998
    slices = c.write_slices(docs, "text", "lang")
    words = c.numbered_words(slices, 3)
    ids = sorted(r.id for r in words.collect())
    assert ids == list(range(1, 113)) and words.select(F.max("f")).first()[0] == 200 * 2001


def test_texts_of_megabytes(spark):
    """A piece of a million words, words of megabytes, and nothing but separators."""
    rng = random.Random(1)
    words = [rng.choice(["the", "of", "a", "x", "yy", "été"]) for _ in range(400_000)]
    rows = [("en", " ".join(words)), ("en", "z" * 3_000_000 + " the of " + "z" * 3_000_000), ("de", "." * 2_000_000), ("de", " " * 2_000_000)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert result(docs, min_count=100, top=300) == plain(rows, 100, 300)
