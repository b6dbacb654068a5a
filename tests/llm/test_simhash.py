"""SimHash against brute force."""
import re

import pytest
import xxhash
from llm_data import edge_docs, no_docs, SMALL, texts_of  # noqa: F401
from pyspark.sql import functions as F

from logonlens.llm import simhash
from logonlens.llm.queries import QUERIES


def plain_fingerprint(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, bits):
    left, out = dict(enumerate(fps)), {}
    while left:
        first = next(iter(left))
        todo, group = [first], {first}
        del left[first]
        while todo:
            x = todo.pop()
            near = [j for j, f in left.items() if (f[1] ^ fps[x][1]).bit_count() <= bits]
            for j in near:
                del left[j]
            todo += near
            group |= set(near)
        ids = [fps[i][0] for i in group if fps[i][0] is not None]
        out |= {i: min(ids) if ids else None for i in group}
    return [out[i] for i in range(len(fps))]


def expected(docs, k, bits):
    fps = [(i, plain_fingerprint(t, k)) for i, t in docs]
    return sorted(((i, f"{f:016x}", c) for (i, f), c in zip(fps, plain_components(fps, bits), strict=True)), key=str)


@pytest.mark.parametrize("bucket_rows", [1, 64])
@pytest.mark.parametrize("segments, bits", [(2, 2), (3, 2), (2, 3)])
def test_equals_brute_force_with_and_without_large_buckets(spark, segments, bits, bucket_rows):
    rows = []
    for g in range(6):
        words = [f"w{g}_{i}" for i in range(60)]
        for v in range(12):
            rows.append((len(rows), " ".join(words[:v] + [f"edit{v}"] * (v % 3) + words[v:])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = simhash.near_duplicates(df, 3, bits, segments=segments, bucket_rows=bucket_rows)
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows, 3, bits)


def test_query_on_the_table(spark):
    got = QUERIES["op10_simhash"](spark, SMALL)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    want = expected(texts_of(spark.read.parquet(f"{SMALL}/documents.parquet")), 3, 2)
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_edge_cases(spark, edge_docs, no_docs):
    got = simhash.near_duplicates(edge_docs, 3, 2).collect()
    assert sorted(map(tuple, got), key=str) == expected(texts_of(edge_docs), 3, 2)
    assert simhash.near_duplicates(no_docs, 3, 2).count() == 0


def test_exploded_tables_are_not_broadcast(spark, monkeypatch):
    """2,000 fingerprints look small to Spark before and after they are made 34 look-ups each."""
    frames, cut = [], simhash.cut
    monkeypatch.setattr(simhash, "cut", lambda df, name: frames.append(df) or cut(df, name))
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("some words"), "id").alias("text"))
    frames.append(simhash.links(docs.select(F.xxhash64("doc_id").alias("fp")), 2))
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in frames]
    assert len(plans) == 2 and all("SortMergeJoin" in p for p in plans)
    assert not any(re.search(r"BroadcastHashJoin .*Inner", p) for p in plans)


def test_documents_are_not_broadcast(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("some words"), "id").alias("text"))
    got = simhash.near_duplicates(docs, 3, 2)
    assert got.count() == 500
    assert re.match(r"(?s).*?(\w+Join)", got._jdf.queryExecution().executedPlan().toString())[1] == "SortMergeJoin"


def test_segment_balls_cover_every_pair():
    for bits in range(5):
        for segments in (1, 2, 3, 4):
            radius = {low: (width, r) for low, width, r in simhash.segments_of(bits, segments)}
            assert sum(r + 1 for _, r in radius.values()) == bits + 1
