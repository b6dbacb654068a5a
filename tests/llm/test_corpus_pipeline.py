"""The pipeline, stage by stage, against plain Python on what the stage before kept."""
import hashlib
import pathlib
import re

import corpus_pipeline as cp
import public_tokenizers
import pytest
import tiktoken
from llm_data import edge_docs, no_docs, SMALL  # noqa: F401
from pyspark.sql import functions as F
from test_simhash import plain_components, plain_fingerprint

from logonlens.llm import byte_bpe, mixing, quality
from logonlens.llm.common import cut
from logonlens.session import ensure_checkpoint_dir


@pytest.fixture(scope="module")
def steps(spark):
    frames = [spark.read.parquet(f"{SMALL}/documents.parquet")]
    for _, stage in cp.STAGES:
        frames.append(cut(stage(spark, frames[-1], SMALL), "test-stage"))
    return frames


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_texts_are_not_broadcast(spark, steps):
    """Also not where their files are small: of a left join only the other side can be."""
    for df in (cp.mix_sources(spark, steps[0], SMALL), cp.written_order(steps[3])):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert re.match(r"(?s).*?Join [^\n]*?(Inner|LeftOuter)", plan)[1] == "LeftOuter"


def test_columns(steps):
    assert all(f.columns == steps[0].columns and f.dtypes == steps[0].dtypes for f in steps[:-1])


def test_quality_keeps_what_it_judges_good(steps):
    kept = {r.doc_id for r in quality.quality(steps[0]).where("kept").collect()}
    assert texts(steps[1]) == {i: t for i, t in texts(steps[0]).items() if i in kept} and 0 < len(kept) < steps[0].count()


def test_one_of_each_near_duplicate_group_stays(steps):
    docs = sorted(texts(steps[1]).items())
    groups = plain_components([(i, plain_fingerprint(t, 3)) for i, t in docs], 2)
    assert texts(steps[2]) == {i: t for (i, t), g in zip(docs, groups, strict=True) if i == g}


def test_repeated_passages_go(steps):
    seen, want = set(), {}
    for i, t in sorted(texts(steps[2]).items()):
        data = t.encode()
        gone = bytearray(len(data))
        for s in range(len(data) - 99):
            if data[s:s + 100] in seen:
                gone[s:s + 100] = b"\1" * 100
            seen.add(data[s:s + 100])
        want[i] = bytes(b for b, g in zip(data, gone, strict=True) if not g).decode(errors="ignore")
    assert texts(steps[3]) == want
    assert want != texts(steps[2])
    assert all(r.n_chars == len(r.text) for r in steps[3].collect())


def test_mixing_keeps_every_row_in_mixed_order(spark, steps):
    assert sorted(map(tuple, steps[4].collect())) == sorted(map(tuple, steps[3].collect()))
    place = {r.doc_id: r.position for r in mixing.mix(steps[3], spread_cols=("text",)).collect()}
    got = [place[r.doc_id] for r in cp.mix_sources(spark, steps[3], SMALL).collect()]
    assert got == sorted(place.values())


def test_encoding_equals_the_library(steps):
    ranks = byte_bpe.read_ranks(cp.MULTI_RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = steps[5].collect()
    docs = texts(steps[4])
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        ids = library.encode_ordinary(docs[r.doc_id])
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        assert (bytes(r.ids), r.n_tokens, r.ids_sha256) == (packed, len(ids), hashlib.sha256(packed).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def test_run_equals_its_stages(spark, steps):
    assert sorted(r.ids_sha256 for r in cp.run(spark, SMALL).collect()) == sorted(r.ids_sha256 for r in steps[5].collect())


def test_edge_cases(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        df = docs
        for _, stage in cp.STAGES[1:]:       # the rules would reject all of these short texts
            df = cut(stage(spark, df, SMALL), "test-edge")
        assert df.count() <= docs.count()
    assert cp.quality_rules(spark, no_docs, SMALL).count() == 0
    assert {r.doc_id for r in cp.simhash_dedup(spark, edge_docs, SMALL).collect()} >= {None, 4, 9}


CLASHING = ["own_id", "own_hash", "own_text", "place", "text_hash", "key", "row", "hash", "position", "k", "component", "kept",
            "file", "own", "h", "bucket", "slot"]


def test_columns_of_the_input_come_back_whatever_their_names(spark):
    small = spark.read.parquet(f"{SMALL}/documents.parquet").where("doc_id < 40")
    docs = cut(small.select("*", *[F.concat(F.lit(f"{c} of "), "doc_id").alias(c) for c in CLASHING]), "test-clash")
    df = docs
    for _, stage in cp.STAGES[:-1]:
        df = cut(stage(spark, df, SMALL), "test-clash")
        assert df.columns == docs.columns and df.dtypes == docs.dtypes
    rows = df.collect()
    assert 0 < len(rows) <= 40 and all(r[c] == f"{c} of {r.doc_id}" for r in rows for c in CLASHING)
    assert cp.encode_texts(spark, df, SMALL).count() == len(rows)


def test_repeated_and_missing_ids(spark):
    """Different texts of one id both stay; of near copies one goes, whatever their ids."""
    word = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()
    texts = [" ".join(word[(i * k + i) % len(word)] for k in range(1, 60)) for i in (2, 3, 5, 7)]
    rows = [(1, texts[0]), (1, texts[1]), (None, texts[2]), (None, texts[0]), (5, texts[2]), (None, texts[3]), (1, texts[0])]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(((r.doc_id, r.text) for r in cp.simhash_dedup(spark, docs, SMALL).collect()), key=str)
    assert got == sorted([(1, texts[0]), (1, texts[1]), (5, texts[2]), (None, texts[3])], key=str)
    assert cp.quality_rules(spark, docs, SMALL).count() <= len(rows)
    mixed = cp.mix_sources(spark, docs, SMALL).collect()
    assert sorted(((r.doc_id, r.text) for r in mixed), key=str) == sorted(rows, key=str)


def test_run_leaves_no_scratch_but_the_last_result(spark):
    folder = pathlib.Path(ensure_checkpoint_dir(spark).removeprefix("file:")) / "logonlens-scratch"
    before = set(folder.iterdir()) if folder.exists() else set()
    assert cp.run(spark, SMALL).count() > 0
    assert [p.name.split("-")[0] for p in set(folder.iterdir()) - before] == ["stage"]


def test_run_gives_the_mixed_order(spark, monkeypatch):
    monkeypatch.setattr(cp, "STAGES", cp.STAGES[3:])       # the stages before it decide no order
    changed = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.files.maxPartitionBytes": "20000"}
    before = {k: spark.conf.get(k) for k in changed}
    place = {r.doc_id: r.position for r in mixing.mix(spark.read.parquet(f"{SMALL}/documents.parquet"),
                                                      spread_cols=("text",)).collect()}
    try:
        for k, v in changed.items():        # many files, read in other partitions than written
            spark.conf.set(k, v)
        rows = cp.run(spark, SMALL).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {r.doc_id: r.position for r in rows} == place
    assert [r.position for r in rows] == list(range(len(place)))


def test_texts_of_megabytes(spark):
    """Every stage on a text of three million characters beside the small table."""
    small = spark.read.parquet(f"{SMALL}/documents.parquet").where("doc_id < 30")
    word = texts(small)
    long_text = "\n".join(" ".join(t.split()[k::2]) for k in range(2) for t in word.values() if t) * 40
    row = spark.createDataFrame([(10_000, long_text, "en", "src0", len(long_text))], small.schema)
    df = cut(small.unionAll(row), "test-long")
    assert cp.quality_rules(spark, df, SMALL).where("doc_id = 10000").count() == 0       # it repeats itself
    for _, stage in cp.STAGES[1:]:
        df = cut(stage(spark, df, SMALL), "test-long")
    got = {r.doc_id: r for r in df.collect()}
    assert 10_000 in got and 0 < got[10_000].n_tokens < len(long_text)
