"""Nearest neighbours against brute force."""
import numpy as np
from llm_data import SMALL
from pyspark.sql import functions as F

from logonlens.llm import ann
from logonlens.llm.queries import QUERIES


def brute(rows, k, every):
    ids = np.array([i for i, _ in rows])
    v = np.array([x for _, x in rows], dtype=np.float64)
    out = {}
    for q in range(len(ids)):
        if ids[q] % every == 0:
            s = v @ v[q]
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[q]][:k]
            out[int(ids[q])] = [(int(ids[j]), s[j]) for j in order]
    return out


def results(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def recall(got, want):
    return sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) for q, w in want.items()) / \
        sum(map(len, want.values()))


def test_recall_and_scores_on_the_table(spark):
    for folder in (SMALL, "/root/testdata/sf0.1"):
        rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
        got, want = results(QUERIES["op8_ann"](spark, folder)), brute(rows, 20, 20)
        assert set(got) == set(want) and all(len(g) == len(want[q]) for q, g in got.items())
        vectors = dict(rows)
        for q, found in got.items():
            for i, s in found:
                assert abs(s - np.dot(np.array(vectors[i], float), np.array(vectors[q], float))) < 1e-12
            assert found == sorted(found, key=lambda x: (-x[1], x[0]))
        assert recall(got, want) >= 0.95


def test_many_cells_copies_and_ties(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(8, 12))
    rows = [(i, (centres[i % 8] + 0.2 * rng.normal(size=12)).tolist()) for i in range(1500)]
    rows += [(2000 + i, rows[0][1]) for i in range(600)]          # one vector 601 times
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = results(ann.nearest(df, F.col("vec_id") % 10 == 0, k=5, cell_rows=100))
    want = brute(rows, 5, 10)
    assert recall(got, want) >= 0.95
    assert [i for i, _ in got[0]] == [i for i, _ in want[0]]       # ties to the smaller id


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (6, [None, 1.0]), (None, [1.0, 1.0]), (20, [0.9, 0.1]), (7, [1.0, 2.0, 3.0]), (8, []), (40, [0.0, 0.0])]
    df = spark.createDataFrame([(*r, 1, 2.0) for r in rows], "vec_id long, embedding array<double>, rank int, score double")
    got = results(ann.nearest(df, F.col("vec_id") % 20 == 0))
    assert {q: [i for i, _ in v] for q, v in got.items()} == {0: [20, 1], 20: [0, 1]}
    assert ann.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert ann.nearest(df.where("vec_id = 0"), F.col("vec_id") % 20 == 0).count() == 0


def test_chi_square():
    assert abs(ann.chi_square_cdf(ann.chi_square_quantile(0.9)) - 0.9) < 1e-9
    assert abs(ann.chi_square_quantile(0.95, 6) - 12.5916) < 1e-3 and abs(ann.chi_square_quantile(0.95, 16) - 26.2962) < 1e-3


def test_repeated_query_rows_give_whole_results(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(300)]
    kind = "vec_id long, embedding array<double>"
    once = results(ann.nearest(spark.createDataFrame(rows, kind), F.col("vec_id") % 50 == 0, k=8, cell_rows=50))
    again = spark.createDataFrame(rows + [rows[0], rows[0]], kind)        # one of the query rows three times
    got = results(ann.nearest(again, F.col("vec_id") % 50 == 0, k=8, cell_rows=50))
    assert len({i for i, _ in got[0]}) == 8 and recall(got, once) >= 0.95
    other = spark.createDataFrame([*rows, (0, rows[7][1])], kind)           # its id with another vector: two queries
    found = [r for r in ann.nearest(other, F.col("vec_id") == 0, k=8, cell_rows=50).collect()]
    assert sorted(r["rank"] for r in found) == sorted([*range(1, 9)] * 2)


def clustered(n, dimensions, clusters, spread, rng):
    centres = rng.normal(size=(clusters, dimensions))
    return centres[rng.integers(0, clusters, n)] + spread * rng.normal(size=(n, dimensions))


def test_few_vectors_are_verified():
    """50,000 clustered vectors in shards: the share of them that queries verify, and what they find."""
    rng = np.random.default_rng(4)
    v = clustered(50_000, 64, 300, 0.35, rng)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    ids, queries = np.arange(len(v)), np.arange(0, len(v), 500)
    index = ann.Index(v[:8192], 64, float((v * v).sum(1).max()), 3)
    cell = index.tree.cells(index.project(v))
    verified, found = 0, {int(q): [] for q in queries}
    bounds = np.full(len(queries), -np.inf)
    own = index.tree.cells(index.project(v[queries], True))
    for first_round in (True, False):
        for c in range(8):
            rows, asked = np.flatnonzero(cell == c), np.flatnonzero((own == c) == first_round)
            which, hit, product, n = ann.search(index, ids[rows], v[rows], queries[asked], v[queries[asked]], bounds[asked], 20, ann.SURE)
            verified += n
            for w, i, s in zip(which.astype(int), hit.astype(int), product, strict=True):
                found[int(queries[asked[w]])].append((-s, i))
        bounds = np.array([-sorted(found[int(q)])[19][0] if len(found[int(q)]) >= 20 else -np.inf for q in queries])
    products = v @ v[queries].T
    hits = 0
    for k, q in enumerate(queries):
        products[q, k] = -np.inf
        hits += len(set(np.argsort(-products[:, k])[:20].tolist()) & {i for _, i in sorted(found[int(q)])[:20]})
    assert hits / (20 * len(queries)) >= 0.9
    assert verified / (len(queries) * len(v)) < 0.3, verified / (len(queries) * len(v))


def test_cells_with_many_queries_are_read_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, x.tolist()) for i, x in enumerate(clustered(900, 8, 5, 0.3, rng))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(ann, "QUERY_ROWS", 20)
    got = results(ann.nearest(df, F.col("vec_id") % 3 == 0, k=6, cell_rows=150))
    want = brute(rows, 6, 3)
    assert set(got) == set(want) and recall(got, want) >= 0.93


def test_queries_of_a_shard_are_searched_side_by_side(monkeypatch):
    rng = np.random.default_rng(5)
    vectors, ids = rng.normal(size=(2000, 24)), rng.permutation(2000)
    queries, query_ids = np.vstack([vectors[:200], 3 * rng.normal(size=(100, 24))]), np.r_[ids[:200], np.arange(5000, 5100)]
    vectors[1500:] = vectors[0]                             # copies tie
    index = ann.Index(vectors[:500], 24, (vectors * vectors).sum(1).max(), 0)
    calls, boxes = [], ann.distance_to_boxes
    monkeypatch.setattr(ann, "distance_to_boxes", lambda *x: calls.append(1) or boxes(*x))
    bounds = np.where(np.arange(300) % 3 == 0, np.sort(queries @ vectors.T)[:, -30], -np.inf)
    which, found, products, verified = ann.search(index, ids, vectors, query_ids, queries, bounds, 20, ann.SURE)
    assert len(calls) <= 3                                  # not one for each query
    assert 0 < verified < 300 * 2000
    monkeypatch.setattr(ann, "SEARCHED_AT_ONCE", 1)         # each query by itself
    alone = ann.search(index, ids, vectors, query_ids, queries, bounds, 20, ann.SURE)
    assert verified == alone[3] and (which == alone[0]).all() and (found == alone[1]).all()
    assert np.allclose(products, alone[2], rtol=1e-12)
    hits = 0
    for q in range(300):
        p = np.where(ids == query_ids[q], -np.inf, vectors @ queries[q])
        hits += len(set(ids[np.lexsort((ids, -p))[:20]]) & set(found[which == q]))
    assert hits >= 0.9 * 300 * 20
