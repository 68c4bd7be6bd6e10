import pytest

tokenizers = pytest.importorskip("tokenizers")

from strandlake.llm import token_cache, vocabulary  # noqa: E402
from llm_fixtures import make_docs  # noqa: F401, E402


def test_counts_and_cache(make_docs, spark, tmp_path):
    library = tokenizers.Tokenizer.from_file(vocabulary.default_path())
    rows = [(0, "Some text"), (1, "Some text"), (2, None), (3, ""), (None, "é" * 900), (4, "x"), (4, "x")]
    cache = str(tmp_path / "cache")
    docs = make_docs(rows)
    want = sorted((str(d), len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for d, t in rows)
    for _ in range(2):
        got = token_cache.count_tokens(docs, cache).collect()
        assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == want
        assert all(r.over_limit == (r.n_tokens > 512) for r in got)
    stored = spark.read.parquet(cache)
    assert stored.select("digest").distinct().count() == 4 and stored.count() == 5  # the repeated row is encoded twice
    more = token_cache.count_tokens(make_docs([(9, "new text"), (10, "x")]), cache).collect()
    assert {r.doc_id: r.n_tokens for r in more} == {9: 2, 10: 1}
    assert spark.read.parquet(cache).count() == 6


def test_stored_counts_are_used_and_versions_kept_apart(make_docs, spark, tmp_path):
    cache = str(tmp_path / "cache")
    path = vocabulary.default_path()
    token_cache.count_tokens(make_docs([(0, "a b")]), cache).count()
    mark = spark.read.parquet(cache).selectExpr("digest", "version", "77L AS n_tokens")
    other = mark.selectExpr("digest", "'other' AS version", "n_tokens")
    fresh = str(tmp_path / "fresh")
    mark.write.parquet(fresh)
    assert token_cache.count_tokens(make_docs([(0, "a b")]), fresh, path).first().n_tokens == 77
    apart = str(tmp_path / "apart")
    other.write.parquet(apart)
    assert token_cache.count_tokens(make_docs([(0, "a b")]), apart, path).first().n_tokens == 2


def test_other_kinds(make_docs):
    import public_tokenizers as files

    assert token_cache.count_tokens(make_docs([(0, "Hello World")]), path=files.path("word_bpe_49k.json")).first().n_tokens == 2
    assert token_cache.count_tokens(make_docs([(0, "Hello World")]), path=files.path("piece_bpe_32k.model")).first().n_tokens >= 2
    assert token_cache.count_tokens(make_docs([])).count() == 0
