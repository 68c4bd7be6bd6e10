import math

import pytest

from strandlake.llm.mixing import BLOCKS, find_exponent, mix
from llm_fixtures import make_docs  # noqa: F401, E402


def rows():
    out = []
    for source, n in (("big", 900), ("mid", 200), (None, 60), ("tiny", 30)):
        out += [(len(out) + i, f"some words {i} of a text in {source}", source) for i in range(n)]
    return out


def tokens(text):
    return len(text.split()) if text else 0


def test_repetition_limit(make_docs):
    data = rows()
    docs = make_docs(data)
    out = mix(docs, copy="turn", place="spot", max_repeats=2.0).collect()
    per = {}
    for r in out:
        per.setdefault(r.source, []).append(r)
    size = {s: sum(tokens(t) for _, t, x in data if x == s) for s in {x for _, _, x in data}}
    largest, smallest = max(size.values()), min(size.values())
    a = 1 - math.log(2) / math.log(largest / smallest)
    z = sum((v / sum(size.values())) ** a for v in size.values())
    for s, v in size.items():
        asked = (largest / v) ** (1 - a)  # passes of this source when the largest is read once
        read = sum(tokens(r.text) for r in per[s]) / v
        assert asked - 0.05 <= read <= asked + 1e-6, (s, asked, read)
        ids = {d for d, _, x in data if x == s}
        assert {r.doc_id for r in per[s] if r.turn == 1} == ids
        assert max(sum(r.doc_id == d for r in per[s]) for d in list(ids)[:20]) <= 2
    assert z > 0


def test_exponent_meets_entropy(spark):
    share = [0.7, 0.2, 0.06, 0.04]
    df = spark.createDataFrame([(x,) for x in share], "share double")

    def entropy(a):
        w = [x ** a for x in share]
        return -sum(x / sum(w) * math.log(x / sum(w)) for x in w) / math.log(4)

    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if entropy(mid) <= 0.8 else (mid, high)
    assert find_exponent(df, 0.8, None) == pytest.approx(high, abs=1e-6)
    assert find_exponent(df, None, None) == pytest.approx(0.0, abs=1e-6)
    assert find_exponent(df, 0.01, None) == 1.0


def test_budget_below_the_corpus(make_docs):
    docs = make_docs(rows())
    out = mix(docs, budget=3000.0, max_repeats=None, entropy=0.9).collect()
    total = sum(tokens(r.text) for r in out)
    assert 2900 <= total <= 3000
    assert len({r.doc_id for r in out}) >= len(out) * 0.5


def test_edges(make_docs):
    docs = make_docs([(None, None, None), (1, "", "a"), (2, "x y", "b"), (2, "x y", "b"), (3, "z " * 40_000, "b")])
    out = mix(docs)
    assert out.columns == docs.columns and out.count() >= 5
    assert mix(make_docs([])).count() == 0
    assert mix(docs).exceptAll(out).count() == 0 and BLOCKS >= 1


def test_source_without_blanks(spark, tmp_path):
    """Unspaced text has one word a document but the most tokens, so it is read once."""
    import corpus_pipeline
    from strandlake.llm.queries import QUERIES

    data = [(i, "数据" * 100 + str(i), "unspaced") for i in range(60)]
    data += [(100 + i, "the data of this line " * 8 + str(i), "spaced") for i in range(60)]
    spark.createDataFrame(data, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for out in (QUERIES["op7_mixing"](spark, str(tmp_path)), corpus_pipeline.mixed(spark, docs, str(tmp_path))):
        times = {r.source: r["count"] for r in out.groupBy("source").count().collect()}
        assert times["unspaced"] == 60 and times["spaced"] > 60


def test_long_document_does_not_end_the_last_pass(make_docs):
    docs = make_docs([(0, "w " * 1000, "s")] + [(i, "w", "s") for i in range(1, 2001)])
    for seed in (1, 2, 3, 4):
        read = sum(tokens(r.text) for r in mix(docs, budget=900.0, seed=seed).collect())
        assert 890 <= read <= 900


@pytest.mark.parametrize("budget", [None, 700.0, 20_000.0])
def test_plan_is_the_recomputed_one(make_docs, budget):
    """Blocks, exponent, whole passes and the last pass, worked out again from the rows."""
    from pyspark.sql import functions as F

    from strandlake.llm import mixing

    data = rows() + [(5000, "long " * 300, "tiny"), (5001, None, "mid"), (5002, "", "empty")]
    docs = make_docs(data)
    plan = {(r.source, r.block): r for r in mixing.mixing_plan(docs, budget=budget).collect()}
    placed = docs.select("source", "text", mixing.block_of().alias("block")).withColumn(
        "rank", F.xxhash64(F.lit(mixing.SEED + 1), "source", "block")).collect()
    blocks = {}
    for r in placed:
        n, _ = blocks.get((r.source, r.block), (0, 0))
        blocks[r.source, r.block] = (n + tokens(r.text), r.rank)
    total = {}
    for (s, _), (n, _) in blocks.items():
        total[s] = total.get(s, 0) + n
    every = sum(total.values())
    share = {s: v / every for s, v in total.items() if v}
    a = 1 - math.log(2) / math.log(max(share.values()) / min(share.values()))
    z = sum(x ** a for x in share.values())
    deal = budget if budget is not None else every * z * max(x ** (1 - a) for x in share.values())
    assert plan.keys() == blocks.keys()
    for s in total:
        asked = deal * (total[s] / every) ** a / z if total[s] else 0.0
        own = sorted((rank, b, n) for (x, b), (n, rank) in blocks.items() if x == s)
        got = [plan[s, b] for _, b, _ in own]
        whole = math.floor(asked / total[s] + 1e-9) if total[s] else 1
        read = {r.whole for r in got}
        # at the limit itself rounding of the exponent may give the last whole pass as a part
        edge = total[s] and abs(asked / total[s] - round(asked / total[s])) < 1e-6
        assert read == {whole} or edge and read == {whole - 1}, s
        assert [r.place for r in got] == list(range(1, len(own) + 1))
        if edge:
            continue
        left = max(0.0, asked - whole * total[s])
        upto = 0
        for (_, _, n), r in zip(own, got):
            upto += n
            takes = n <= left if n else upto <= max(0.0, asked - whole * total[s])
            assert r.part == takes, (s, r)
            left -= n if takes else 0
