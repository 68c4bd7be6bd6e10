"""Readers and writers through files."""

import json
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import DATA, rows
from strandlake.functions.dates import calendar
from strandlake.operators import performance
from strandlake.operators.sets import same_rows
from strandlake.sources import sinks, tabular


@pytest.fixture()
def orders(spark):
    return spark.read.parquet(f"{DATA}/orders.parquet")


def files(path, suffix):
    return [f for _, _, names in os.walk(path) for f in names if f.endswith(suffix)]


def test_csv_and_in_place_query(spark, tmp_path):
    (tmp_path / "v.csv").write_text("CHROM,POS,ID,REF,ALT,QUAL,FILTER,DP,AF,GQ,GENE,CONSEQUENCE\nchr1,5,.,A,G,31.5,PASS,10,0.1,20,.,x\n")
    path = str(tmp_path / "v.csv")
    inferred, declared = tabular.read_csv(spark, path), tabular.read_csv(spark, path, tabular.VARIANT_SCHEMA)
    assert rows(inferred.select("POS", "QUAL")) == rows(declared.select("POS", "QUAL")) == [(5, 31.5)]
    text = "SELECT CHROM, count(*) FILTER (WHERE QUAL > :q) AS n FROM {file} GROUP BY CHROM"
    assert rows(tabular.query_csv(spark, path, text, args={"q": 30})) == [("chr1", 1)]


def test_bed(spark, tmp_path):
    (tmp_path / "g.bed").write_text("chr1\t10\t20\tG1\t+\n")
    assert rows(tabular.read_bed(spark, str(tmp_path / "g.bed"))) == [("chr1", 10, 20, "G1", "+")]


def test_json_array(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps([{"id": "p1", "genes": ["A", "B"]}, {"id": "p2", "genes": []}]))
    df = tabular.read_json_array(spark, str(tmp_path / "p.json"), "id string, genes array<string>")
    assert rows(df.select("id", F.explode("genes"))) == [("p1", "A"), ("p1", "B")]


def test_drifting_files(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "d/a"))
    spark.range(2).withColumn("depth", F.lit(7)).write.parquet(str(tmp_path / "d/b"))
    df = tabular.read_drifting(spark, str(tmp_path / "d/*"))
    assert df.filter("depth is null").count() == 2 and df.count() == 4


def test_partitioned_write_prunes(spark, tmp_path, orders):
    path = str(tmp_path / "o")
    sinks.write_partitioned(orders, path, ["o_orderstatus"], files_per_key=2)
    assert len(files(path, ".parquet")) <= 6
    back = tabular.read_partitioned(spark, path)
    one = back.filter("o_orderstatus = 'F'")
    assert "PartitionFilters: [isnotnull(o_orderstatus" in performance.plan_text(one)
    assert same_rows(back.select(*orders.columns), orders)


def test_exports_round_trip(spark, tmp_path, orders):
    sinks.write_delimited(orders, str(tmp_path / "t"), "\t")
    back = tabular.read_csv(spark, str(tmp_path / "t"), orders.schema.simpleString()[7:-1].replace(":", " ").replace(",", ", "), "\t")
    assert sinks.round_trip_equal(orders, back)
    sinks.write_parquet(orders, str(tmp_path / "p"), sort_by=["o_orderdate"])
    assert same_rows(tabular.read_parquet(spark, str(tmp_path / "p")), orders)
    assert not same_rows(orders, orders.limit(10))


def test_table_from_query(spark, tmp_path, orders):
    sinks.create_table_as(orders.groupBy("o_orderstatus").count(), "status_counts", str(tmp_path / "ctas"))
    assert spark.table("status_counts").count() == 3
    spark.sql("DROP TABLE status_counts")


def test_compaction(spark, tmp_path, orders):
    source, target = str(tmp_path / "many"), str(tmp_path / "few")
    orders.repartition(12).write.parquet(source)
    assert sinks.compact(spark, source, target) == 1
    report = {r["layout"]: r["files"] for r in sinks.layout_report(
        {"many": spark.read.parquet(source), "few": spark.read.parquet(target)}).collect()}
    assert report == {"many": 12, "few": 1} and same_rows(spark.read.parquet(target), orders)
    sinks.append_batches([orders, orders], str(tmp_path / "twice"))
    assert spark.read.parquet(str(tmp_path / "twice")).count() == 2 * orders.count()


def test_client_rows_and_calendar(spark):
    tabular.client_table(spark, pd.DataFrame({"code": ["F"], "n": [1]}), "client_codes")
    assert spark.sql("SELECT n FROM client_codes WHERE code = 'F'").first()[0] == 1
    assert calendar(spark, "2024-02-27", "2024-03-01").count() == 4


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert tabular.nan_to_null(df).filter("x is null").count() == 1


def test_performance_helpers(spark, orders):
    assert set(performance.compare({"a": orders, "b": orders.limit(5)})) == {"a", "b"}
    assert performance.partition_sizes(performance.by_hash(orders, 5, "o_custkey")).count() <= 5
    assert performance.partition_skew(performance.fewer(orders.repartition(6), 2)).first()["partitions"] == 2
    with performance.kept(orders) as held:
        assert held.is_cached and held.count() == 1500
    assert not orders.is_cached
