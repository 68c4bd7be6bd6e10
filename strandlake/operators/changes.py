"""Table changes as pure functions: each derives the next version of a table.

Nothing is updated in place; the caller writes the returned DataFrame as a new version.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


#: Rows of both sides together that one task of a large anti join gets.
JOIN_ROWS = 500_000


def _without(df: DataFrame, keys: DataFrame, on: list[str], rows: int) -> DataFrame:
    """Rows of ``df`` whose key is not among ``keys``; ``rows`` is a bound of the rows that meet, 0 if ``keys`` are few.

    Spark merges shuffled parts up to a size in compressed bytes, and ordered keys compress so well that a merged part holds
    many millions of rows to sort. So many rows are dealt to a number of tasks that follows them, which is not merged.
    """
    tasks = -(-rows // JOIN_ROWS)
    if tasks > df.sparkSession.sparkContext.defaultParallelism:
        df, keys = df.repartition(tasks, *on), keys.repartition(tasks, *on)
    return df.join(keys, on, "left_anti")


def _meeting(df: DataFrame, keys: DataFrame) -> int:
    many = keys.count()
    return many + df.count() if many > JOIN_ROWS else 0


def merge_upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """DML-01: rows of the source replace or join those of the target."""
    return _without(target, source.select(*keys), keys, _meeting(target, source)).unionByName(source)


def merge_update_only(target: DataFrame, source: DataFrame, keys: list[str], column: str) -> DataFrame:
    """DML-02: take one column from the source where it has the key; insert nothing."""
    new = source.select(*keys, F.col(column).alias("_new"), F.lit(True).alias("_hit"))
    return (target.join(new, keys, "left")
            .withColumn(column, F.when(F.col("_hit"), F.col("_new")).otherwise(F.col(column)))
            .select(*target.columns))


def upsert_columns(target: DataFrame, source: DataFrame, keys: list[str], updated: list[str]) -> DataFrame:
    """DML-03: on a conflict only the listed columns change; other rows of the source are inserted whole."""
    t, s = target.withColumn("_t", F.lit(True)), source.withColumn("_s", F.lit(True))
    both = t.alias("t").join(s.alias("s"), keys, "full")
    columns = []
    for c in target.columns:
        old, new = F.col(f"t.{c}"), F.col(f"s.{c}")
        if c in keys:
            columns.append(F.col(c))
        elif c in updated:
            columns.append(F.when(F.col("_s"), new).otherwise(old).alias(c))
        else:
            columns.append(F.when(F.col("_t"), old).otherwise(new).alias(c))
    return both.select(*columns)


def update_where(df: DataFrame, condition: Column, changes: dict[str, Column]) -> DataFrame:
    """DML-04: UPDATE ... WHERE; rows for which the condition is NULL stay as they are."""
    return df.withColumns({c: F.when(condition, v).otherwise(F.col(c)) for c, v in changes.items()})


def update_keys(df: DataFrame, keys: DataFrame, on: list[str], changes: dict[str, Column]) -> DataFrame:
    """DML-04: UPDATE ... WHERE key IN (table of keys)."""
    marked = df.join(keys.select(*on).distinct().withColumn("_hit", F.lit(True)), on, "left")
    return update_where(marked, F.col("_hit"), changes).select(*df.columns)


def delete_keys(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """DML-05."""
    return _without(df, keys.select(*on), on, _meeting(df, keys))


def replace_keys(df: DataFrame, rows: DataFrame, on: list[str]) -> DataFrame:
    """DML-05: delete by key, then insert the new rows."""
    return delete_keys(df, rows, on).unionByName(rows)


def schema_report(left: StructType, right: StructType) -> list[tuple[str, str, str | None, str | None]]:
    """DML-08: (column, finding, left type, right type) for every difference."""
    a = {f.name: f.dataType.simpleString() for f in left.fields}
    b = {f.name: f.dataType.simpleString() for f in right.fields}
    out = [(c, "only_left", a[c], None) for c in a if c not in b]
    out += [(c, "only_right", None, b[c]) for c in b if c not in a]
    out += [(c, "type_mismatch", a[c], b[c]) for c in a if c in b and a[c] != b[c]]
    return out


def schema_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """DML-08 as a DataFrame."""
    return left.sparkSession.createDataFrame(
        schema_report(left.schema, right.schema),
        "column_name string, finding string, left_type string, right_type string")


def append_enforced(table: DataFrame, batch: DataFrame) -> DataFrame:
    """DML-06: append a batch of the same columns and types; any other batch is refused."""
    found = schema_report(table.schema, batch.schema)
    if found:
        raise ValueError(f"batch refused: {found}")
    return table.unionByName(batch)


def append_merged(table: DataFrame, batch: DataFrame) -> DataFrame:
    """DML-07: append with new columns; rows without them hold NULL. A changed type is still refused."""
    clash = [r for r in schema_report(table.schema, batch.schema) if r[1] == "type_mismatch"]
    if clash:
        raise ValueError(f"batch refused: {clash}")
    return table.unionByName(batch, allowMissingColumns=True)


def stack_versions(frames: dict[int, DataFrame]) -> DataFrame:
    """Versions of a table as one table with a ``version`` column."""
    out = None
    for version, df in frames.items():
        part = df.withColumn("version", F.lit(version))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def version_counts(versions: DataFrame) -> DataFrame:
    """DML-09: rows per version."""
    return versions.groupBy("version").agg(F.count("*").alias("n"))


def changed_values(old: DataFrame, new: DataFrame, keys: list[str], column: str) -> DataFrame:
    """JOIN-21, DML-09: keys whose value differs between two versions, NULL-safe."""
    a = old.select(*keys, F.col(column).alias("old_value"))
    b = new.select(*keys, F.col(column).alias("new_value"))
    return a.join(b, keys).filter(~F.col("old_value").eqNullSafe(F.col("new_value")))


def added_rows(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """DML-09: rows whose key the old version lacks."""
    return new.join(old.select(*keys), keys, "left_anti")


def as_of(history: DataFrame, keys: list[str], moment: Column, valid_from: str = "valid_from",
          deleted: str = "is_deleted") -> DataFrame:
    """DML-10: a table as it stood at a moment, from its change history.

    ``history`` holds one row per change, a deletion as a row with ``is_deleted``. The newest row
    per key is a partial aggregate; keys whose newest row is a deletion are gone.
    """
    rest = [c for c in history.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.col(valid_from)).alias("_v")
    return (history.filter(F.col(valid_from) <= moment).groupBy(*keys).agg(newest)
            .filter(~F.col(f"_v.{deleted}"))
            .select(*keys, *[F.col(f"_v.{c}").alias(c) for c in rest if c != deleted]))


def recover_deleted(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """DML-10: the later version with rows deleted since the earlier one put back."""
    # The later version is not counted, as that would make it once more; it is taken to be no larger than the earlier one.
    return after.unionByName(_without(before, after.select(*keys), keys, 2 * before.count()))


def change_audit(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """DML-11: one row per inserted, deleted or really changed value: keys, operation, column, old, new."""
    a = old.select(*keys, *[F.col(c).alias(f"_o_{c}") for c in columns], F.lit(True).alias("_old"))
    b = new.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in columns], F.lit(True).alias("_new"))
    operation = (F.when(F.col("_old").isNull(), "INSERT").when(F.col("_new").isNull(), "DELETE")
                 .otherwise("UPDATE"))
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_o_{c}").cast("string").alias("old_value"),
                               F.col(f"_n_{c}").cast("string").alias("new_value")) for c in columns])
    return (a.join(b, keys, "full").select(*keys, operation.alias("operation"), F.inline(cells))
            .filter(~F.col("old_value").eqNullSafe(F.col("new_value"))))


def backfill(df: DataFrame, column: str, value: Column) -> DataFrame:
    """DML-12: fill a new column, then require that it holds no NULL (checked when the rows are read)."""
    filled = F.coalesce(F.col(column), value)
    return df.withColumn(column, F.when(filled.isNotNull(), filled).otherwise(
        F.raise_error(F.lit(f"{column} is still missing")).cast(df.schema[column].dataType)))


def registry_upsert(registry: DataFrame, entries: DataFrame, key: str, content: list[str]) -> DataFrame:
    """DML-14: register entries; a known name gets the next version, a new name version 1.

    ``registry`` has the columns of ``entries`` plus ``version``.
    """
    known = registry.select(key, F.col("version").alias("_v"))
    bumped = (entries.join(known, key, "left")
              .withColumn("version", F.coalesce(F.col("_v") + 1, F.lit(1)).cast(registry.schema["version"].dataType))
              .select(key, *content, "version"))
    return registry.join(entries.select(key), key, "left_anti").select(key, *content, "version").unionByName(bumped)
