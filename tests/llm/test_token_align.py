"""Alignment against the libraries on whole texts, byte by byte."""
import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from llm_data import edge_docs, no_docs, SMALL  # noqa: F401
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from logonlens.llm import token_align

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
LIBRARY_A, LIBRARY_B = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
LIBRARY_A.encode_special_tokens = True
LETTERS = token_align._byte_letters()


def plain_tokens(text):
    """(ids, byte ends) of both, by whole texts and decoded bytes alone."""
    whole = (" " + text).encode()
    ids_a = LIBRARY_A.encode(" " + text, add_special_tokens=False).ids
    bytes_a = [bytes(LETTERS[c] for c in LIBRARY_A.id_to_token(i)) for i in ids_a]
    ids_b = LIBRARY_B.encode(text)
    bytes_b = [bytes([int(p[3:5], 16)]) if LIBRARY_B.is_byte(i) else p.replace("▁", " ").encode()
               for i, p in ((i, LIBRARY_B.id_to_piece(i)) for i in ids_b)]
    if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return None
    out = []
    for ids, parts in ((ids_a, bytes_a), (ids_b, bytes_b)):
        at = 0
        spans = []
        for i, p in zip(ids, parts, strict=True):
            spans.append((i, at, at + len(p)))
            at += len(p)
        out.append(spans)
    return out


def plain_figures(rows):
    tokens = [plain_tokens(t) for _, t in rows]
    linked = [[] if x is None else [(a, b) for a, s, e in x[0] for b, f, g in x[1] if s < g and f < e] for x in tokens]
    count = Counter(p for links in linked for p in set(links))
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    out = []
    for (i, _), x, links in zip(rows, tokens, linked, strict=True):
        groups = []
        if x is not None:
            cuts = sorted({e for _, _, e in x[0]} & {e for _, _, e in x[1]})
            for s, e in zip([0, *cuts[:-1]], cuts, strict=True):
                groups.append("|".join(",".join(str(i) for i, f, g in side if s <= f and g <= e) for side in x))
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if x is not None else ""
        out.append((i, len(x[0]) if x else 0, len(x[1]) if x else 0, len(groups), len(links),
                    sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links), digest))
    return Counter(out)


def figures(df):
    return Counter(tuple(r) for r in token_align.alignment_figures(df, A, B).collect())


def rows_of(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


ODD = ["hello wörld 😀 x", "żółw 漢字 漢 字漢", "a  b   c", " lead", "trail ", "\t\n x\r\n", "▁x", "x ▁ y", "é ﬁ ½ Å 　a b",
       "<s> <unk> <|endoftext|> </s>", "a\x00b", "it's we'll 'tis can't", "\x1c a\x1f b\x85 c\xa0 d", "😀😀 👩‍👩‍👧 🇩🇪", "1234567 89,0.1", "ab" * 4000,
       "the same the same the same", "न्यूज़ हिन्दी", "​ ﻿ x", "漢" * 300, "  ", " ", "\n"]


@pytest.fixture(scope="module")
def docs(spark):
    small = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").where("length(text) < 3000 AND doc_id % 3 = 0")
    return small.unionAll(spark.createDataFrame([(9000 + i, t) for i, t in enumerate(ODD)], small.schema)).repartition(5)


def test_figures(spark, docs, edge_docs, no_docs):
    for df in (docs, edge_docs):
        assert figures(df) == plain_figures(rows_of(df))
    assert token_align.alignment_figures(no_docs, A, B).count() == 0


def test_slices_and_memo_of_any_size(spark, docs, monkeypatch):
    want = figures(docs)
    for name, value in (("SLICE_UNITS", 50), ("MEMO_UNITS", 100), ("MEMO_CHARS", 5), ("TOGETHER", 3), ("TOGETHER_CHARS", 20), ("LINE_UNITS", 2), ("TEXTS_TOGETHER", 2)):
        monkeypatch.setattr(token_align, name, value)
    assert figures(docs) == want


def test_groups(docs):
    for r in token_align.aligned_groups(docs, A, B).collect():
        text = [t for i, t in rows_of(docs.where(F.col("doc_id") == r.doc_id))][0] if r.doc_id >= 9000 else None
        if text is None:
            continue
        tokens = plain_tokens(text)
        assert [i for g in r.groups for i in g.a] == ([] if tokens is None else [i for i, _, _ in tokens[0]])
        assert [i for g in r.groups for i in g.b] == ([] if tokens is None else [i for i, _, _ in tokens[1]])


def test_a_broken_vocabulary_is_refused(monkeypatch):
    monkeypatch.setattr(SentencePieceProcessor, "id_to_piece", lambda self, i: "a▁b")
    monkeypatch.setattr(SentencePieceProcessor, "is_byte", lambda self, i: False)
    with pytest.raises(ValueError, match="word mark"):
        token_align.Cutter(A, B)


def test_texts_of_megabytes(spark):
    """Many words, one word without a space, and one line of a script with long characters."""
    few, many = ["hello wörld now", "x" * 100, "漢字" * 50], ["hello wörld now " * 150_000, "x" * 300_000, "漢字" * 60_000]
    rows = list(enumerate([many[0].strip(), *many[1:]]))
    got = {r.doc_id: r for r in token_align.alignment_figures(spark.createDataFrame(rows, "doc_id long, text string"), A, B).collect()}
    for i, text in rows:
        ids_a, ids_b = LIBRARY_A.encode(" " + text, add_special_tokens=False).ids, LIBRARY_B.encode(text)
        assert (got[i].n_a, got[i].n_b) == (len(ids_a), len(ids_b)) and got[i].n_groups > 0
        assert max(got[i].n_a, got[i].n_b) <= got[i].n_links < got[i].n_a + got[i].n_b
    one = plain_figures([(0, few[0])])
    assert got[0].n_links == 150_000 * next(iter(one))[4] and got[0].n_groups == 150_000 * next(iter(one))[3]


def test_slices_go_back_one_at_a_time(docs):
    """No batch of the last step holds two slices, and no array the sums of all their pairs."""
    plan = token_align.alignment_figures(docs, A, B)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "MapInArrow" not in plan.replace("FlatMapCoGroupsInArrow", "")
    assert "collect_list" not in plan


def test_distinct_and_numbers():
    for values in ([], [3], [3, 1, 3, 3, 2 ** 40, 1]):
        assert token_align._distinct(np.array(values, np.int64)).tolist() == sorted(set(values))
    numbers = token_align.Numbers()
    assert [numbers[w] for w in "abacb"] == [0, 1, 0, 2, 1] and list(numbers) == ["a", "b", "c"]


def test_a_slice_of_many_distinct_words(spark):
    distinct = token_align.SLICE_DISTINCT // 2
    text = " ".join(f"{k:x}" for k in range(distinct))
    rows = [(1, text), (2, f"{distinct - 1:x} 0"), (3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r for r in token_align.alignment_figures(df, A, B).collect()}
    few = next(iter(plain_figures([(2, rows[1][1])])))
    assert (got[2].n_a, got[2].n_b, got[2].n_groups, got[2].n_links, got[2].groups_sha256) == (*few[1:5], few[7])
    ids_a, ids_b = LIBRARY_A.encode(" " + text, add_special_tokens=False).ids, LIBRARY_B.encode(text)
    assert (got[1].n_a, got[1].n_b) == (len(ids_a), len(ids_b)) and got[3].n_a == 0
    assert got[1].count_sum >= got[1].n_links and got[2].count_sum >= 2 * got[2].n_links


def test_words_are_aligned_in_parts(monkeypatch):
    """Any number of words at once gives the same; the arrays of a part stay small."""
    cutter = token_align.Cutter(A, B)
    records = cutter.cut(["hello", "wörld", "漢字", "x\x00y", "▁", "", "the"] * 3)
    whole, seen, part = token_align.Aligned(records, cutter), [], token_align.Aligned._part
    monkeypatch.setattr(token_align.Aligned, "_part", staticmethod(lambda some, c: seen.append(len(some)) or part(some, c)))
    for size in (1, 4, 100):
        monkeypatch.setattr(token_align, "ALIGNED_TOGETHER", size)
        parts = token_align.Aligned(records, cutter)
        assert parts.groups == whole.groups
        assert all((getattr(parts, k) == getattr(whole, k)).all() for k in ("n_a", "n_b", "n_groups", "n_links", "pairs"))
        assert max(seen) == min(size, len(records))
        seen.clear()
    assert token_align.Aligned([], cutter).groups == []


def test_tasks_hold_one_slice_at_a_time(spark):
    """Two slices of one task, each as many different words as a slice has: a row group each."""
    n = token_align.SLICE_DISTINCT
    text = F.array_join(F.transform(F.sequence(F.col("id") * n, F.col("id") * n + n - 1), lambda x: x.cast("string")), " ")
    docs = spark.range(2, numPartitions=1).select(F.col("id").alias("doc_id"), text.alias("text"))
    slices = token_align.write_slices(docs, A, B, "doc_id", "text")
    files = [pq.ParquetFile(f.removeprefix("file:")).metadata for f in slices.inputFiles()]
    assert [(m.num_rows, m.num_row_groups) for m in files if m.num_rows] == [(2, 2)]
