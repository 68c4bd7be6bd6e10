import numpy as np

from strandlake.llm.rabitq import nearest_neighbours


def brute(rows, k, every):
    ok = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        ok[i] = min(ok.get(i, list(v)), list(v))
    out = {}
    for q in ok:
        if q % every == 0:
            s = [(-float(np.dot(np.array(ok[q], np.float32).astype(float), np.array(v, np.float32).astype(float))), i)
                 for i, v in ok.items() if i != q and len(v) == len(ok[q])]
            out[q] = [i for _, i in sorted(s)[:k]]
    return out


def test_recall(spark, monkeypatch):
    monkeypatch.setattr("strandlake.llm.rabitq.CANDIDATE_BLOCK", 300)
    monkeypatch.setattr("strandlake.llm.rabitq.QUERY_BLOCK", 20)
    g = np.random.default_rng(1)
    centres = g.standard_normal((12, 64))
    x = (centres[g.integers(0, 12, 1500)] + 0.6 * g.standard_normal((1500, 64))).astype(np.float32)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    got = {}
    for r in nearest_neighbours(spark.createDataFrame(rows, "vec_id long, vec array<float>")).collect():
        got.setdefault(r.query_id, {})[r.rank] = r.vec_id
        assert abs(r.score - float(np.dot(x[r.query_id].astype(float), x[r.vec_id].astype(float)))) < 1e-9
    want = brute(rows, 20, 20)
    assert got.keys() == want.keys() and all(sorted(v) == list(range(1, 21)) for v in got.values())
    hit = sum(len(set(got[q].values()) & set(want[q])) for q in want)
    assert hit >= 0.99 * sum(map(len, want.values()))


def test_ties_and_odd_rows(spark):
    same = [1.0, 2.0, 0.5]
    rows = [(i, same) for i in range(40)] + [(100, [0.0, 0.0, 0.0]), (101, None), (102, [1.0, None, 2.0]), (103, [float("nan"), 1.0, 1.0]),
                                             (104, [float("inf"), 1.0, 1.0]), (None, same), (3, same), (120, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, vec array<float>").selectExpr("*", "1 AS d", "2 AS rank", "3 AS code")
    got = {}
    for r in nearest_neighbours(df).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    assert {q: [v for _, v in sorted(x)] for q, x in got.items()} == {0: list(range(1, 21)), 20: list(range(20))}
    assert nearest_neighbours(df.limit(0)).count() == 0


def test_given_table(spark):
    from strandlake.llm.queries import QUERIES

    data = "/root/testdata/sf0.001"
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{data}/embeddings.parquet").collect()]
    got = {}
    for r in QUERIES["op3_rotated_codes"](spark, data).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = brute(rows, 20, 20)
    assert got.keys() == want.keys()
    assert sum(len(got[q] & set(want[q])) for q in want) >= 0.99 * sum(map(len, want.values()))
