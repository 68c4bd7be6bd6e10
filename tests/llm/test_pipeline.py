"""The pipeline's stages against brute force, each on what its predecessor kept."""

import hashlib
from collections import Counter

import numpy as np
import pytest

tokenizers = pytest.importorskip("tokenizers")

import corpus_pipeline  # noqa: E402
from strandlake.llm import vocabulary  # noqa: E402
from strandlake.llm.queries import QUERIES  # noqa: E402
from strandlake.llm.simhash import simhash  # noqa: E402
from strandlake.llm.toxicity import toxicity_scores  # noqa: E402
from test_line_dedup import brute as brute_lines  # noqa: E402
from test_simhash import brute as brute_prints  # noqa: E402

DATA = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(k))
        stage(spark, docs, DATA).write.parquet(path)
        out = spark.read.parquet(path)
        kept[name] = (docs, out)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        docs = out

    before, after = kept["toxicity"]
    fine = {r.doc_id for r in toxicity_scores(before, labels).where("predicted = 0").collect()}
    assert {r.doc_id for r in after.collect()} == fine

    before, after = kept["line dedup"]
    rows = {r.doc_id: r.text for r in before.collect()}
    want = brute_lines(sorted(rows.items()))
    wrong = 0
    for r in after.collect():
        lines = [x for i, x in enumerate(rows[r.doc_id].split("\n")) if want.get((r.doc_id, i), True)]
        wrong += "\n".join(lines) != r.text
    assert wrong <= 0.02 * len(rows)  # banding may miss a pair close to the threshold

    before, after = kept["simhash near-dedup"]
    ids = brute_prints([(r.doc_id, simhash(r.text) & (2**64 - 1)) for r in before.collect()])
    assert sorted(r.doc_id for r in after.collect()) == sorted(set(ids.values()))

    before, after = kept["source mixing"]
    times = Counter(r.doc_id for r in after.collect())
    assert times.keys() == {r.doc_id for r in before.collect()} and max(times.values()) <= 2

    before, after = kept["bpe encoding"]
    library = tokenizers.Tokenizer.from_file(vocabulary.default_path())
    want = Counter()
    for r in before.collect():
        ids = np.array(library.encode(r.text, add_special_tokens=False).ids, "<u4")
        want[(r.doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in after.collect()) == want

    whole = Counter((r.doc_id, r.ids_sha256) for r in QUERIES["pipeline"](spark, DATA).collect())
    assert whole == Counter((r.doc_id, r.ids_sha256) for r in after.collect())


def test_every_operator_has_a_query():
    assert [int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")] == list(range(1, 14))
    assert "pipeline" in QUERIES and corpus_pipeline.ORACLE_SQL is None
