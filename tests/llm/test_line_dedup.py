"""Line dedup against plain Python."""
import hashlib
from collections import Counter, defaultdict

import pytest
from llm_data import edge_docs, no_docs, SMALL  # noqa: F401

from logonlens.llm import line_dedup
from logonlens.llm.common import cut

LAST = (1 << 63) - 1


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\f\r"))


def plain_dedup(rows, min_chars=10):
    """Every (id, text): lines, lines that go, remaining text."""
    first = defaultdict(lambda: LAST)
    for i, t in rows:
        for x in t.split("\n"):
            first[key_of(x)] = min(first[key_of(x)], LAST if i is None else i)
    out = []
    for i, t in rows:
        lines = t.split("\n")
        kept = [x for x in lines if len(key_of(x)) < min_chars or first[key_of(x)] == (LAST if i is None else i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


def rows_of(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


def result(df, **how):
    return Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in line_dedup.dedup_lines(df, **how).collect())


def test_small_table_and_digests(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = plain_dedup(rows_of(docs))
    assert result(docs) == want and any(dropped for _, _, dropped, _ in want)
    got = Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in line_dedup.digests(docs).collect())
    assert got == Counter((i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in want)


LINE = "a line of some length"
TEXTS = [
    (5, f"{LINE}\nshort\n{LINE}"), (2, f"  {LINE.upper()}\t\r\n\nshort\n"), (9, LINE), (9, f"other start\n{LINE}"),
    (9, f"other start\n{LINE}"), (None, f"{LINE}\nonly without an id"), (None, "only without an id"), (3, "ten chars!\nnine char"),
    (4, "ten chars!\nnine char"), (6, "Ä line öf letters\n ten chars!"), (7, "ä line öf letters\nÄ LINE öF LETTERS"), (8, "\n\n\n"),
    (1, None), (0, ""), (10, "x" * 300_000), (11, "y\n" + "x" * 300_000), (12, " \x0b\x0cten chars!\x0c \nA\x00nul in a line\nß")]


@pytest.mark.parametrize("min_chars", [1, 10])
def test_edge_cases(spark, edge_docs, no_docs, min_chars):
    docs = spark.createDataFrame([(i, t, "k", 1) for i, t in TEXTS], "doc_id long, text string, key string, doc int")
    for df in (docs, edge_docs):
        assert result(df, min_chars=min_chars) == plain_dedup(rows_of(df), min_chars)
    assert line_dedup.dedup_lines(no_docs).count() == 0


def test_hot_keys_are_salted_and_long_texts_have_sparse_bitmaps(spark):
    """One line in every document and thousands of times in one; a document of 30,000 lines."""
    rows = [(i, f"the line that all documents hold\nline number {i} alone\nline of {i % 40} kinds") for i in range(1, 900)]
    rows += [(2000, "\n".join(f"line number {i} alone" if i % 400 == 77 else f"own line {i} of a long text" for i in range(30_000))),
             (2001, "\n".join(["the line that all documents hold"] * 5000))]
    docs = cut(spark.createDataFrame(rows, "doc_id long, text string"), "line-test")
    assert result(docs) == plain_dedup(rows)
    hashes = cut(line_dedup.line_rows(line_dedup._documents(docs, "doc_id", "text")), "line-test")
    hot = line_dedup.frequent(hashes, 8).collect()
    assert [r.salts > 1 for r in hot] == [True]
    maps = {r.doc: r for r in line_dedup.keep_bitmaps(docs).collect()}
    assert len(maps[2000].keep) == maps[2000].n_dropped == 3 and len(maps[2001].keep) == -(-5000 // 64)


def test_keys_stream_in_one_range_shuffle(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = cut(line_dedup.line_rows(line_dedup._documents(docs, "doc_id", "text")), "line-test")
    plan = line_dedup.dropped_lines(rows)._jdf.queryExecution().executedPlan().toString()
    below_window = plan.split("Window ", 1)[1]
    assert "rangepartitioning(h1" in below_window and "hashpartitioning" not in below_window.split("rangepartitioning")[0]


def test_texts_of_megabytes(spark):
    """One line of megabytes twice, and a text of 400,000 lines of which an earlier one holds some."""
    long_line = "a long line " * 300_000
    rows = [(1, long_line), (2, f"  {long_line}\nend"), (3, "\n".join(f"number {i} of many lines" for i in range(0, 400_000, 1000))),
            (4, "\n".join(f"number {i} of many lines" for i in range(400_000)))]
    docs = cut(spark.createDataFrame(rows, "doc_id long, text string"), "line-test")
    assert result(docs) == plain_dedup(rows)
