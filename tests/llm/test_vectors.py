import numpy as np
from pyspark.sql import functions as F

from docloom.llm import ann, topk


def vectors(n, dims, seed, groups=20):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((groups, dims))
    out = centres[rng.integers(0, groups, n)] + 0.4 * rng.standard_normal((n, dims))
    return (out / np.linalg.norm(out, axis=1, keepdims=True)).astype(np.float32)


def frame(spark, found):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(found)]
    rows += [(9001, None), (9002, [float("nan")] * found.shape[1]), (9003, [0.0] * found.shape[1]), (9004, [1.0]), (None, rows[0][1]), (3, rows[3][1])]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)


def test_top_k_is_exact(spark):
    found = vectors(700, 16, 1)
    found[50:60] = found[50]  # ties
    rows = topk.top_k(frame(spark, found), F.pmod("vec_id", F.lit(50)) == 0, k=5).collect()
    whole = np.floor(found.astype(np.float64) * 256).astype(np.int64)
    for q in range(0, 700, 50):
        scores = [(-(int(whole[q] @ whole[i])), i) for i in range(700) if i != q] + [(0, 9003)]
        assert [(r.vec_id, r.score) for r in sorted((r for r in rows if r.query_id == q), key=lambda r: r.rank)] == [(i, -s) for s, i in sorted(scores)[:5]]


def test_nearest_recall_and_scores(spark):
    found = vectors(2000, 32, 2)
    rows = ann.nearest(frame(spark, found), F.pmod("vec_id", F.lit(20)) == 0, k=20).collect()
    exact = found.astype(np.float64)
    hit = 0
    for q in range(0, 2000, 20):
        own = sorted((r for r in rows if r.query_id == q), key=lambda r: r.rank)
        assert len(own) == 20 and [r.rank for r in own] == list(range(1, 21)) and all(a.score >= b.score for a, b in zip(own, own[1:], strict=False))
        assert all(abs(r.score - exact[q] @ exact[r.vec_id]) < 1e-12 for r in own)
        scores = exact @ exact[q]
        scores[q] = -np.inf
        hit += len({r.vec_id for r in own} & set(np.argsort(-scores)[:20].tolist()))
    assert hit >= 0.9 * 20 * 100


def test_few_candidates_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (20, [0.5, 0.5]), (7, [0.0, 1.0])], "vec_id long, embedding array<double>")
    rows = ann.nearest(df, F.pmod("vec_id", F.lit(20)) == 0).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id, r.score) for r in rows] == [(0, 20, 0.5), (0, 7, 0.0), (20, 0, 0.5), (20, 7, 0.5)]
    assert ann.nearest(df.limit(0), F.pmod("vec_id", F.lit(20)) == 0).collect() == []
    assert topk.top_k(df.limit(0), F.pmod("vec_id", F.lit(50)) == 0).collect() == []


def test_nearest_stops_before_all_are_verified():
    """The chi-square test ends searches: fewer than half of the vectors are verified, and recall stays."""
    found = vectors(6000, 64, 3, groups=6000).astype(np.float64)  # no groups: the hard case
    ids, asked = np.arange(6000), np.arange(0, 6000, 60)
    scores = found[asked] @ found.T
    scores[np.arange(100), asked] = -np.inf
    verified = []
    at, hit, _ = ann.search_shard(ids, found, asked, found[asked], 20, (found**2).sum(1).max(), np.sort(scores, 1)[:, -40], False, verified)
    assert sum(verified) < 0.5 * 6000 * 100
    got = [set(hit[at == i].tolist()) for i in range(100)]
    assert sum(len(got[i] & set(np.argsort(-scores[i])[:20].tolist())) for i in range(100)) >= 0.9 * 20 * 100


def test_top_k_prunes_where_vectors_have_groups():
    """Balls are left out by their bound. Without any groups in 64 dimensions none can be (see the README)."""
    found = np.floor(256 * vectors(4000, 16, 4, groups=40).astype(np.float64))
    asked, verified = np.arange(0, 4000, 50), []
    scores = found[asked] @ found.T
    scores[np.arange(80), asked] = -np.inf
    least = np.sort(scores, 1)[:, -8]
    at, ids, got = topk.search_shard(np.arange(4000), found, asked, found[asked], least, 5, False, verified)
    assert sum(verified) < 0.5 * 4000 * 80
    assert all(sorted(got[at == i])[::-1] == sorted(scores[i])[::-1][:5] for i in range(80))


def test_lengths_large_components_and_clashing_names(spark):
    rows = [(0, [1e30, 0.0], 1), (50, [1.0, -1.0], 2), (3, [2.0, 0.0], 3), (100, [1.0], 4), (4, [2.0], 5), (7, [], 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int").withColumns({"rank": F.lit("x"), "key": F.lit(1), "query": F.lit(1), "least": F.lit(0)})
    found = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.top_k(df, F.pmod("vec_id", F.lit(50)) == 0).collect()}
    assert found[50, 1] == (0, 2**63 - 1024)  # beyond a long: the nearest one
    assert found[50, 2] == (3, 256 * 512) and found[100, 1] == (4, 256 * 512) and (100, 2) not in found
    near = [(r.query_id, r.vec_id) for r in ann.nearest(df, F.pmod("vec_id", F.lit(50)) == 0).orderBy("query_id", "rank").collect()]
    assert near == [(0, 3), (0, 50), (50, 0), (50, 3), (100, 4)]


def test_nearest_ties_go_to_the_smaller_id(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0, 3.0]) for i in range(45)], "vec_id long, embedding array<double>")
    rows = ann.nearest(df, F.pmod("vec_id", F.lit(20)) == 0, k=5).orderBy("query_id", "rank").collect()
    assert [r.vec_id for r in rows] == [1, 2, 3, 4, 5, 0, 1, 2, 3, 4, 0, 1, 2, 3, 4]
