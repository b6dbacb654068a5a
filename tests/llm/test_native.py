"""Quality rules, license scan and mixing against plain Python."""
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from llm_data import edge_docs, no_docs, SMALL, texts_of  # noqa: F401
from pyspark.sql import functions as F

from logonlens.llm import license_scan, mixing, quality
from logonlens.llm.queries import QUERIES


# ------------------------------------------------------------------ quality

def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    twice = Counter(windows)
    covered = {j for i, w in enumerate(windows) if twice[w] > 1 for j in range(i, i + 8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered), failed)


REPEATS = ["a b c d e f g h " * 3, " ".join("abcdefgh") + " x " + " ".join("abcdefgh"), "line one\nline one\n \n \nx",
           "w " * 40, "# * $ % & | < > #"]


def test_quality_counts_equal_plain_python(spark, edge_docs):
    small = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang")
    extra = spark.createDataFrame([(1000 + i, t, "en") for i, t in enumerate(REPEATS)], small.schema)
    for docs in (small, extra, edge_docs):
        got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                      for r in quality.quality(docs).collect()), key=str)
        assert got == sorted(((i, *plain_counts(t)) for i, t in texts_of(docs)), key=str)


def plain_js(a, b):
    a, b = [x / sum(a) for x in a], [x / sum(b) for x in b]
    kl = lambda p, m: sum(x * math.log2(x / y) for x, y in zip(p, m, strict=True) if x)
    m = [(x + y) / 2 for x, y in zip(a, b, strict=True)]
    return math.sqrt(max(0, (kl(a, m) + kl(b, m)) / 2))


def test_quality_distances_equal_plain_python(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", F.when(
        F.col("doc_id") % 7 > 0, F.col("lang")).alias("lang"))
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    keeps = ["A-Z", "a-z", "0-9", r"\x20\x09-\x0D", "#*$%&|<>", ".,;:!?", "\x80-\U0010ffff"]

    def classes(t):
        own = [len(re.findall(f"[{k}]", t)) for k in keeps]
        return [*own, len(t) - sum(own)]

    def short(t):
        return [w for w in (x.strip(".,;:!?|").lower() for x in re.findall(r"[^\x20\x09-\x0D]+", t)) if 1 <= len(w) <= 5]

    by_lang, words, n_words = defaultdict(lambda: [0] * 8), defaultdict(Counter), Counter()
    for _, t, lang in rows:
        for key in {lang, None}:                  # None: all texts together
            by_lang[key] = [x + y for x, y in zip(by_lang[key], classes(t), strict=True)]
            words[key].update(short(t))
            n_words[key] += len(re.findall(r"[^\x20\x09-\x0D]+", t))
    common = {k: [w for w, c in sorted(words[k].items(), key=lambda x: (-x[1], x[0]))[:32] if c >= 1e-4 * n_words[k]]
              for k in words}
    want = {}
    for i, t, lang in rows:
        if lang is None:
            hits = sorted((-len(set(short(t)) & set(common[k])), k) for k in words if k)
            lang = hits[0][1] if hits[0][0] else None
        share = [words[lang][w] for w in common[lang]]
        own = Counter(short(t))
        counts = [own[w] for w in common[lang]]
        n = len(re.findall(r"[^\x20\x09-\x0D]+", t))
        chars = plain_js(classes(t), by_lang[lang]) if len(t) >= 200 else None
        wd = None
        if n >= 50:
            full = [*share, n_words[lang] - sum(share)]
            wd = plain_js([*counts, n - sum(counts)], full) / plain_js([0] * len(share) + [1], full)
        want[i] = (chars, wd)
    rows = quality.quality(docs).collect()
    assert len(rows) == len(want)
    for r in rows:
        for got, exp in zip((r.char_distance, r.word_distance), want[r.doc_id], strict=True):
            assert (got is None) == (exp is None) and (got is None or abs(got - exp) < 1e-9)
        assert r.kept == (not r.base_failed and (r.char_distance or 0) <= quality.MAX_CHAR_DISTANCE
                          and (r.word_distance or 0) <= quality.MAX_WORD_DISTANCE)
    assert {r.kept for r in rows} == {True, False}


def test_quality_rejects_texts_without_common_words(spark):
    """Also without a language, and where every word is long; the result can be filtered."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang")
    rng = random.Random(5)
    junk = [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=8)) for _ in range(500)) for _ in range(4)]
    extra = spark.createDataFrame([(9000 + i, t, lang) for i, (t, lang) in enumerate(zip(junk, ["en", "de", None, "xx"], strict=True))],
                                  docs.schema)
    got = quality.quality(docs.unionAll(extra))
    kept = {r.doc_id for r in got.where("kept").collect()}
    assert not kept & {9000, 9001, 9002} and 9003 in kept       # the only text of its language is its reference
    without = quality.quality(docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, F.col("lang"))))
    assert len({r.doc_id for r in without.where("kept").collect()} ^ (kept - {9003})) <= 0.05 * docs.count()


def test_quality_without_language_or_rows(spark, edge_docs, no_docs):
    alien = edge_docs.withColumn("lang", edge_docs.lang.substr(9, 1))
    assert quality.quality(alien).count() == edge_docs.count()
    assert quality.quality(no_docs).count() == 0


def test_every_language_has_a_reference(spark):
    rows = [(i, f"word{i} the of and to " * 15, f"l{i:03}") for i in range(260)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for limit in (before, "-1"):        # broadcast, and joined by a shuffle
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            got = quality.quality(docs).collect()
            assert len(got) == 260 and all(r.char_distance is not None and r.word_distance is not None for r in got)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# ------------------------------------------------------------------ license scan

def plain_scan(docs, templates, threshold):
    words = {k: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
             for k, (_, t) in enumerate(docs)}
    out = []
    for k, w in words.items():
        places, base, labels, best = [], set(), set(), 0.0
        for phrase, label in license_scan.PHRASES:
            p = phrase.split()
            at = [i for i in range(len(w)) if w[i:i + len(p)] == p]
            places += at
            base |= {label} if at else set()
        for label, text in templates:
            size, own = len(text.split()), set(text.split())
            for s in range(0, len(w), size):       # every block, no filter
                share = len(own & set(w[s:s + 2 * size])) / len(own)
                if share >= threshold - 1e-9:
                    labels.add(label)
                    best = max(best, share)
        out.append((docs[k][0], len(w), len(places), min(places, default=None), max(places, default=None),
                    ",".join(sorted(base)), ",".join(sorted(base | labels)), 1.0 if base else best))
    return sorted(out, key=str)


STATEMENTS = [
    "x y. Licensed under CC BY-NC 4.0. Next", "MIT License and MIT license; the General  Public\nLicense",
    "permission is granted free of charge to any person obtaining a copy of this software and its associated "
    "documentation files to deal in software without any restriction", "under the terms of license",
    "filler " * 37 + "Released under the MIT License.", "MITLicense mit-license mit_license"]


def test_whole_licences_and_a_table_of_templates(spark, no_docs):
    """Whole texts inside others, with words left out; templates as a DataFrame of any size."""
    rng = random.Random(11)
    whole = [(label, t) for label, t in license_scan.TEMPLATES if len(t.split()) > 50]
    texts = []
    for k, (_, t) in enumerate(whole):
        for missing in (0, 0.05, 0.3):
            words = [w for w in t.split() if rng.random() >= missing]
            texts.append("x " * rng.randint(0, 300) + ", ".join(words).upper() + " y" * (17 * k))
    docs = spark.createDataFrame([(i if i % 4 else None, t) for i, t in enumerate(texts + texts[:2])], "doc_id long, text string")
    got = license_scan.license_scan(docs).collect()
    assert sorted(map(tuple, got), key=str) == plain_scan(texts_of(docs), license_scan.TEMPLATES, license_scan.THRESHOLD)
    assert all({label for label, _ in whole} <= {x for r in got for x in r.labels.split(",")} for label, _ in whole)
    many = [(f"label{i % 7}", " ".join(rng.choice("abcdefghij") + str(rng.randint(0, 30)) for _ in range(rng.randint(1, 40))))
            for i in range(300)]
    texts = [" ".join(f"{rng.choice('abcdefghij')}{rng.randint(0, 30)}" for _ in range(60)) + f" {many[i][1]} end" for i in range(25)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    table = spark.createDataFrame([*many, (None, "a1 b2"), ("empty", ""), ("none", None)], "label string, text string")
    got = license_scan.license_scan(docs, templates=table).collect()
    assert sorted(map(tuple, got), key=str) == plain_scan(texts_of(docs), many, license_scan.THRESHOLD)
    assert license_scan.license_scan(no_docs).count() == 0


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_license_scan_equals_plain_scan(spark, edge_docs, threshold):
    small = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(2000 + i, t) for i, t in enumerate(STATEMENTS)], small.schema)
    for docs in (small.unionAll(extra), edge_docs):
        got = license_scan.license_scan(docs, threshold=threshold).collect()
        want = plain_scan(texts_of(docs), license_scan.TEMPLATES, threshold)
        assert sorted(map(tuple, got), key=str) == want


# ------------------------------------------------------------------ mixing

def most_apart(order, weight):
    """The largest deviation of any source's share of any prefix from its target, in entries."""
    had, worst = Counter(), 0.0
    for t, s in enumerate(order):
        had[s] += 1
        # a source is furthest ahead just after an entry of it, and furthest behind just before
        worst = max(worst, had[s] - weight[s] * (t + 1), weight[s] * t - (had[s] - 1))
    return max(worst, *(abs(had[s] - w * len(order)) for s, w in weight.items()))


WEIGHTS = [
    {"a": 0.61, "b": 0.3, "c": 0.09}, {"a": 0.5, "b": 0.5}, {"only": 3.0}, {"a": 0.9, "b": 0.05, "c": 0.03, "d": 0.02},
    {f"s{k}": 1.0 for k in range(20)}, {f"s{k}": 0.5 ** k for k in range(12)}, {"a": 1 / 3} | {f"s{k}": 1.0 / 300 for k in range(200)}]


@pytest.mark.parametrize("weights", WEIGHTS + [{"a": 1 / 3} | {f"s{k}": 1.0 / 2250 for k in range(1500)}])
def test_slots_deviate_from_the_weights_by_less_than_a_block(spark, weights):
    """Against the weights themselves, over at least 20 rounds of all sources."""
    total = sum(weights.values())
    slots = max(3000, 20 * len(weights))
    sizes = spark.createDataFrame([(s, 1) for s in weights], "source string, n long")
    plan = mixing.schedule(sizes, weights)
    halves = plan.select("source", "path", F.explode(F.sequence(F.lit(0), F.ceil(F.col("w") / total * slots) + 2)).alias("i"))
    got = sorted((r.slot, r.source) for r in halves.select("source", mixing.slot_of("path", F.col("i")).alias("slot")).collect())
    got = got[:slots]
    assert [t for t, _ in got] == list(range(slots))         # every slot has one source
    assert most_apart([s for _, s in got], {s: w / total for s, w in weights.items()}) < 2


@pytest.mark.parametrize("weights", [None, {"a": 0.61, "b": 0.3, "c": 0.09}])
def test_mixed_rows_follow_the_weights(spark, weights):
    rows = [(i, "a" if i % 3 == 0 else "b" if i % 5 else "c") for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, source string")
    block = 4
    for buckets in (7, None):
        got = sorted(mixing.mix(df, weights=weights, block_rows=block, buckets=buckets).collect(), key=lambda r: r.position)
        assert [r.position for r in got] == list(range(len(rows)))
        assert sorted((r.doc_id, r.source) for r in got) == sorted(rows)
        assert [r.slot for r in got] == sorted(r.slot for r in got)
        sizes = Counter(r.source for r in got)
        weight = weights or {s: n ** 0.5 for s, n in sizes.items()}
        total = sum(weight.values())
        weight = {s: w / total for s, w in weight.items()}
        until, left = 0, dict(sizes)                          # while all sources have rows
        while min(left.values()):
            left[got[until].source] -= 1
            until += 1
        assert until > 300
        assert most_apart([r.source for r in got[:until]], weight) < block
        assert all(n == block for (s, b), n in Counter((r.source, r.block) for r in got).items() if (b + 1) * block <= sizes[s])
    assert got == sorted(mixing.mix(df, weights=weights, block_rows=block).collect(), key=lambda r: r.position)


def test_one_id_for_many_rows_is_spread(spark):
    """Rows without an id, and equal rows."""
    rows = [(None, "a", f"text {i}") for i in range(500)] + [(7, "a", "same")] * 300 + [(i, "b", "x") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mixing.mix(df, spread_cols=("text",)).collect()
    assert sorted(r.position for r in got) == list(range(1000))
    assert Counter((r.doc_id, r.source) for r in got) == Counter((i, s) for i, s, _ in rows)
    hashed = df.select(F.md5(F.concat_ws("/", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5("text"))).alias("h"))
    assert hashed.distinct().count() >= 700


def test_mixing_edge_cases(spark, edge_docs, no_docs):
    got = mixing.mix(edge_docs, spread_cols=("text",), keep=("score", "n_tokens")).collect()
    assert sorted(r.position for r in got) == list(range(edge_docs.count()))
    assert {r.source for r in got} == {"s", None} and {r.row.score for r in got} == {0.5, 0.0}
    assert mixing.mix(no_docs).count() == 0
    for wrong in ({"z": 1.0}, {"s": 0.0}):
        with pytest.raises(Exception, match="no target weight"):
            mixing.mix(edge_docs, weights=wrong).collect()


def test_queries_on_the_tables(spark):
    n = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    for name in ("op2_mixing", "op4_license_scan", "op6_quality"):
        assert QUERIES[name](spark, SMALL).count() == n
