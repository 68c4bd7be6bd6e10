import math
import random
from zlib import crc32

import numpy as np
import pytest

from strandlake.llm.toxicity import TRAIN_ROWS, drop_toxic, ftrl, toxicity_scores
from llm_fixtures import make_docs  # noqa: F401, E402

DATA = "/root/testdata/sf0.1"


def corpus():
    r = random.Random(5)
    words = [f"word{k}" for k in range(500)]
    rows, labels = [], []
    for i in range(1500):
        text = [r.choice(words) for _ in range(40)]
        bad = i % 5 == 0
        if bad:
            text[r.randrange(40)] = r.choice(["nasty", "Vile!", "(awful)"])
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_held_out_accuracy(spark, make_docs):
    rows, labels = corpus()
    rows += [(None, "nasty"), (5000, None), (5001, ""), (5002, "word1 " * 20_000), (3, rows[3][1])]
    marks = spark.createDataFrame(labels + [(None, 1, 1), (7, 1, None)], "doc_id long, quality int, toxic int")
    out = toxicity_scores(make_docs(rows), marks).collect()
    assert len(out) == len(rows)
    truth = {d: t for d, _, t in labels}
    held = [x for x in out if x.held_out and x.doc_id in truth]
    assert all(x.held_out == (x.doc_id is not None and crc32(str(x.doc_id).encode()) % 5 == 0) for x in out)
    assert sum(x.predicted == truth[x.doc_id] for x in held) >= 0.98 * len(held)
    assert all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.5) for x in out)


def test_held_out_labels_do_not_matter(spark, make_docs):
    rows, labels = corpus()
    kind = "doc_id long, quality int, toxic int"
    turned = [(d, q, 1 - t if crc32(str(d).encode()) % 5 == 0 else t) for d, q, t in labels]
    a, b = (toxicity_scores(make_docs(rows), spark.createDataFrame(x, kind)).orderBy("doc_id").collect() for x in (labels, turned))
    assert a == b


def test_stage_and_empty(spark, make_docs):
    rows, labels = corpus()
    docs = make_docs(rows)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    left = drop_toxic(docs, marks)
    assert left.columns == docs.columns
    bad = {d for d, _, t in labels if t}
    ids = {r.doc_id for r in left.collect()}
    assert len(ids & bad) <= 0.03 * len(bad) and len({d for d, _ in rows} - bad - ids) == 0
    assert toxicity_scores(make_docs([]), marks.limit(0)).count() == 0
    assert {r.score for r in toxicity_scores(docs, marks.limit(0)).collect()} == {0.5}


def test_given_tables(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    out = toxicity_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert TRAIN_ROWS <= 20_000
    assert sum(r.predicted == r.toxic for r in out) >= 0.97 * len(out)


def test_limit_counts_labels_of_present_documents(spark, make_docs):
    """Labels of documents that are not in the table do not use up the rows to fit on."""
    from strandlake.llm.toxicity import train

    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(4000)], "doc_id long, toxic int")
    docs = make_docs([(i, "nasty rude awful" if i % 2 == 0 else "calm kind quiet") for i in range(400)])
    few = train(docs, labels, 200)
    same = train(docs, labels.where("doc_id < 400"), 200)
    assert len(same[0]) and few[0].tolist() == same[0].tolist() and few[1].tolist() == same[1].tolist()


def plain_ftrl(rows, labels, epochs, alpha, beta, l1, l2):
    """FTRL-proximal coordinate by coordinate, as its authors state it."""
    z, n, bias = {}, {}, [0.0, 0.0]

    def weight(zi, ni, l1):
        return 0.0 if abs(zi) <= l1 else -(zi - math.copysign(l1, zi)) / ((beta + math.sqrt(ni)) / alpha + l2)

    def step(zi, ni, w, g):
        sigma = (math.sqrt(ni + g * g) - math.sqrt(ni)) / alpha
        return zi + g - sigma * w, ni + g * g

    for _ in range(epochs):
        for x, y in zip(rows, labels):
            w = {i: weight(z.get(i, 0.0), n.get(i, 0.0), l1) for i in x}
            b = weight(*bias, 0.0)
            g = 1 / (1 + math.exp(-(sum(w.values()) + b))) - y
            for i in x:
                z[i], n[i] = step(z.get(i, 0.0), n.get(i, 0.0), w[i], g)
            bias = list(step(*bias, b, g))
    return {i: v for i in z if (v := weight(z[i], n[i], l1))}, weight(*bias, 0.0)


def test_weights_equal_plain_ftrl():
    r = np.random.default_rng(3)
    for l1 in (0.0, 0.5, 2.0):
        rows = [np.unique(r.integers(0, 60, r.integers(0, 20))).astype(np.uint32) for _ in range(250)]
        labels = np.array([float(5 in x or r.random() < 0.1) for x in rows])
        want, bias = plain_ftrl([x.tolist() for x in rows], labels, 3, 0.5, 1.0, l1, 0.1)
        at, weight, b = ftrl(rows, labels, 3, 0.5, 1.0, l1, 0.1)
        assert at.tolist() == sorted(want) and b == pytest.approx(bias, abs=1e-9)
        assert weight.tolist() == pytest.approx([want[i] for i in at.tolist()], abs=1e-9)


def test_texts_that_share_an_id_give_one_model(spark, make_docs):
    rows, labels = corpus()
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    more = [(i, f"nasty word{i} again") for i in range(0, 1500, 3)]
    scores = [sorted((x.doc_id, x.score) for x in toxicity_scores(make_docs(some).repartition(n), marks).collect())
              for n, some in ((3, rows + more), (7, more + rows))]
    assert scores[0] == scores[1]


def test_bytes_of_features_are_bounded(spark, make_docs, monkeypatch):
    rows, labels = corpus()
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    monkeypatch.setattr("strandlake.llm.toxicity.TRAIN_BYTES", 0)
    assert {x.score for x in toxicity_scores(make_docs(rows), marks).collect()} == {0.5}
