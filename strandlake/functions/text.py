"""Text functions: ids, labels, natural ordering, access-log lines, JSON fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The access-log line format and its six captured parts.
ACCESS_LOG_PATTERN = r'^(\S+) \S+ \S+ \[([^\]]+)\] "(\S+) (\S+) [^"]*" (\d{3}) (\d+)'
ACCESS_LOG_FIELDS = ("client", "stamp", "method", "path", "status", "bytes")


def chromosome_of(col: Column) -> Column:
    """STR-01: the number, X or Y after ``chr``; empty when absent."""
    return F.regexp_extract(col, r"chr(\d+|X|Y)", 1)


def canonical_id(col: Column, prefix: str = "SAMPLE_") -> Column:
    """STR-02: ``prefix`` plus the first digits padded to three, else the upper-case text."""
    upper = F.upper(F.trim(col))
    digits = F.regexp_extract(upper, r"(\d+)", 1)
    padded = F.when(F.length(digits) >= 3, digits).otherwise(F.lpad(digits, 3, "0"))
    return F.when(digits == "", upper).otherwise(F.concat(F.lit(prefix), padded))


def natural_key(*cols: Column) -> Column:
    """STR-03: parts joined with ``|``; NULL when any part is NULL, as CONCAT does."""
    pieces: list[Column] = []
    for i, col in enumerate(cols):
        pieces += [F.lit("|"), col] if i else [col]
    return F.concat(*pieces)


def title_case(col: Column) -> Column:
    """STR-04: trimmed, first letter of each word upper case."""
    return F.initcap(F.trim(col))


def mapped_label(col: Column, mapping: dict[str, object]) -> Column:
    """STR-06: lookup of a label; unknown values give NULL."""
    entries = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), col)


def chromosome_order(col: Column) -> Column:
    """SRT-02: numeric names by value, X as 23, Y as 24, others 999."""
    bare = F.regexp_replace(F.upper(col), "^CHR", "")
    return (F.when(bare == "X", 23).when(bare == "Y", 24)
            .otherwise(F.coalesce(F.try_to_number(F.regexp_extract(bare, r"^(\d{1,6})$", 1), F.lit("999999"))
                                  .cast("int"), F.lit(999))))


def parse_access_log(lines: DataFrame, col: str = "value") -> DataFrame:
    """STR-07: one row per matching line; lines of another form are dropped."""
    text = F.col(col)
    parts = [F.regexp_extract(text, ACCESS_LOG_PATTERN, i + 1).alias(name)
             for i, name in enumerate(ACCESS_LOG_FIELDS)]
    return (lines.filter(text.rlike(ACCESS_LOG_PATTERN)).select(*parts)
            .withColumn("status", F.col("status").cast("int"))
            .withColumn("bytes", F.col("bytes").cast("bigint")))


def json_field(col: Column, path: str, type_name: str) -> Column:
    """JSN-01: one typed field of a JSON text; NULL when the text or the value is malformed."""
    return F.get_json_object(col, path).try_cast(type_name)


def json_object(**fields: Column) -> Column:
    """JSN-01: JSON text built from columns."""
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))
