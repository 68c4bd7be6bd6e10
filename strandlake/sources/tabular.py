"""Table readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Declared schemas of the genomics tables.
VARIANT_SCHEMA = ("CHROM string, POS bigint, ID string, REF string, ALT string, QUAL double, FILTER string, DP int, "
                  "AF double, GQ int, GENE string, CONSEQUENCE string")
BED_SCHEMA = "chrom string, start int, end int, gene_name string, strand string"
BED6_SCHEMA = "chrom string, start int, end int, name string, score double, strand string"
KNOWN_VARIANT_SCHEMA = "CHROM string, POS int, ID string, clinical_significance string, disease string"
EVENT_SCHEMA = ("event_id string, timestamp string, sample_id string, run_id string, chrom string, pos int, ref string, "
                "alt string, qual double, depth int, allele_freq double, variant_type string, gene string, "
                "classification string")


def read_csv(spark: SparkSession, path: str, schema: str | StructType | None = None, sep: str = ",") -> DataFrame:
    """SRC-01: CSV with header; pass a schema outside exploration, inference reads the file twice."""
    reader = spark.read.option("header", True).option("sep", sep)
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def read_bed(spark: SparkSession, path: str, schema: str = BED_SCHEMA) -> DataFrame:
    """SRC-02: headerless TSV with a declared schema."""
    return spark.read.schema(schema).option("sep", "\t").csv(path)


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """SRC-03: files, folders or globs."""
    return spark.read.parquet(*paths)


def with_file_name(df: DataFrame) -> DataFrame:
    """SRC-04: the source file of every row."""
    return df.select("*", F.col("_metadata.file_name").alias("file_name"))


def rows_per_file(df: DataFrame) -> DataFrame:
    return with_file_name(df).groupBy("file_name").agg(F.count("*").alias("n"))


def read_drifting(spark: SparkSession, *paths: str) -> DataFrame:
    """SRC-05: files whose columns differ, united by name; absent columns are NULL."""
    return spark.read.option("mergeSchema", True).parquet(*paths)


def read_json_array(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """SRC-06: a JSON array of objects."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def query_csv(spark: SparkSession, path: str, text: str, schema: str | None = None, args: dict | None = None) -> DataFrame:
    """SRC-07: query text over a CSV file in place; the text names it ``{file}``."""
    return spark.sql(text, args=args, file=read_csv(spark, path, schema))


def read_partitioned(spark: SparkSession, root: str, schema: str | None = None) -> DataFrame:
    """SRC-08: ``key=value`` folders; filters on the keys prune folders."""
    return (spark.read.schema(schema) if schema else spark.read).parquet(root)


def read_commented(spark: SparkSession, path: str, schema: str, sep: str = "\t",
                   skip: tuple[str, ...] = ("^#",), header: bool = False) -> DataFrame:
    """SRC-09: delimited text without comment and dimension lines.

    ``skip`` holds patterns of lines to leave out, e.g. ``^#`` and, for an expression matrix file, its
    line of two counts. With ``header`` the line of column names is left out too.
    """
    fields = StructType.fromDDL(schema).fields
    lines = spark.read.text(path).withColumn("value", F.rtrim("value", F.lit("\r")))
    for pattern in skip:
        lines = lines.filter(~F.col("value").rlike(pattern))
    parts = F.split("value", sep, -1)
    rows = lines.select(*[F.try_element_at(parts, F.lit(i + 1)).alias(f.name) for i, f in enumerate(fields)])
    if header:
        first = fields[0].name
        rows = rows.filter(F.lower(first) != first.lower())
    return rows.select(*[F.nullif(F.col(f.name), F.lit("")).try_cast(f.dataType).alias(f.name) for f in fields])


def expression_matrix(spark: SparkSession, path: str, samples: list[str]) -> DataFrame:
    """SRC-09: an expression matrix file (version line, counts line, header) as (Name, Description, samples...)."""
    schema = "Name string, Description string, " + ", ".join(f"`{s}` double" for s in samples)
    return read_commented(spark, path, schema, skip=("^#", r"^\d+\t\d+$"), header=True)


def client_table(spark: SparkSession, data, name: str, schema: str | None = None) -> DataFrame:
    """SRC-14: client-side rows as a named view that joins with tables."""
    df = spark.createDataFrame(data, schema) if schema else spark.createDataFrame(data)
    df.createOrReplaceTempView(name)
    return df


def json_stream(spark: SparkSession, folder: str, schema: str = EVENT_SCHEMA, files_per_batch: int | None = None) -> DataFrame:
    """SRC-17, STM-05: stream of JSON records, from the oldest file when the checkpoint is new."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(folder)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN and NULL unified, the rule for silver tables."""
    floats = [c for c, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})
