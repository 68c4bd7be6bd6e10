"""One query for each operator, applied to its whole table with production parameters; SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.llm.base import prepare
from strandlake.llm.bpe import encode_decode
from strandlake.llm.compression_rules import quality
from strandlake.llm.conversation_repair import repair
from strandlake.llm.html_extraction import main_text
from strandlake.llm.library_tokens import token_count
from strandlake.llm.line_dedup import line_decisions
from strandlake.llm.mixing import mix
from strandlake.llm.rabitq import nearest_neighbours
from strandlake.llm.simhash import simhash_components
from strandlake.llm.source_divergence import source_divergence
from strandlake.llm.suffix_dedup import remove_repeats
from strandlake.llm.token_cache import count_tokens
from strandlake.llm.token_files import token_files_round_trip
from strandlake.llm.toxicity import toxicity_scores


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line with more than blanks, the line it is a copy of, and whether it stays."""
    return line_decisions(_table(spark, sf_dir, "documents")).select(
        "doc_id", "line_no", "keep_doc_id", "keep_line_no", "kept")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def op3_rotated_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every 20th vector by inner product."""
    return nearest_neighbours(_table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vec")))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_table(spark, sf_dir, "documents"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files_round_trip(_table(spark, sf_dir, "documents"))


def op6_compression_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(_table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as often as the mix reads it, with its pass and its block's place in the pass."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs, tokens=token_count(F.col("text")), copy="copy", place="place").select("doc_id", "source", "copy", "place")


def op8_token_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents, from a cache that is new at each call, so every distinct text is a miss."""
    return count_tokens(_table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(_table(spark, sf_dir, "documents"))


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(_table(spark, sf_dir, "pages"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cost and edits of every conversation, with the digest of its repaired rows."""
    return repair(_table(spark, sf_dir, "conversations"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(_table(spark, sf_dir, "documents").select("lang", "source", "text"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_simhash": op2_simhash,
    "op3_rotated_codes": op3_rotated_codes,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_token_files": op5_token_files,
    "op6_compression_rules": op6_compression_rules,
    "op7_mixing": op7_mixing,
    "op8_token_cache": op8_token_cache,
    "op9_toxicity": op9_toxicity,
    "op10_bpe": op10_bpe,
    "op11_html_extraction": op11_html_extraction,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_source_divergence": op13_source_divergence,
    "pipeline": pipeline,
}

#: SQL for the queries that SQL can express at a bearable speed; the others are tested against brute force.
SQL: dict[str, str] = {
    "op13_source_divergence": r"""
        WITH d AS (
            SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents),
        w AS (SELECT id, lang, source, unnest(terms) AS term FROM d),
        kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 10),
        langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
        n AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
        groups AS (
            SELECT g.lang, g.source, coalesce(sum(n.n), 0) AS total
            FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN n USING (lang, source) GROUP BY ALL),
        shares AS (
            SELECT g.lang, g.source, k.term, coalesce(n.n, 0) AS n,
                1 + (1000000000 * (coalesce(n.n, 0) + 2)::HUGEINT) // (g.total + 2 * l.v) AS p,
                1 + (1000000000 * (k.n + 2)::HUGEINT) // (l.total + 2 * l.v) AS q
            FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN n USING (lang, source, term)),
        pairs AS (
            SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
            FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        found AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
            UNION ALL
            SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM shares WHERE n > 0 AND p > q)
        SELECT lang, source, part, item, value::BIGINT AS value,
            (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
        FROM found QUALIFY part = 'pair' OR rank <= 10""",
}
