"""Schema'd table readers: Parquet scans, master projections, headered CSV, delimited bulk loads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from kestrel.functions.temporal import auto_timestamp
from kestrel.operators.shape import dedup_columns_ci
from kestrel.session import written

# The shared driver tables.
DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                 "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """One Parquet table of a folder (``<base_dir>/<name>.parquet``)."""
    return spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazy accessor for the driver tables of one scale factor: ``Tables(spark, d).orders``."""

    def __init__(self, spark: SparkSession, base_dir: str):
        self.spark, self.base_dir = spark, base_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in DRIVER_TABLES:
            raise AttributeError(name)
        return read_table(self.spark, self.base_dir, name)

    def register_views(self) -> None:
        for name in DRIVER_TABLES:
            read_table(self.spark, self.base_dir, name).createOrReplaceTempView(name)


def project_master(df: DataFrame, columns: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Keep the named columns in the order the source has them, then rename by position."""
    wanted = set(columns)
    missing = wanted - set(df.columns)
    if missing:
        raise ValueError(f"columns not found: {sorted(missing)}")
    kept = [c for c in df.columns if c in wanted]
    return df.select(*[F.col(f"`{c}`") for c in kept]).toDF(*names)


def read_master_csv(spark: SparkSession, path: str, columns: Sequence[str], names: Sequence[str]) -> DataFrame:
    """S6 on a sheet exported to CSV with a header row."""
    return project_master(spark.read.option("header", True).csv(path), columns, names)


def read_header_names(spark: SparkSession, path: str, sep: str = ",") -> list[str]:
    """Header fields of a CSV exactly as written; the line is parsed by Spark's CSV reader, quotes included."""
    first = spark.read.text(path).limit(1).collect()
    if not first:
        return []
    line = first[0][0].lstrip("\ufeff")
    fields = F.from_csv(F.lit(line), ", ".join(f"c{i} string" for i in range(line.count(sep) + 1)), {"sep": sep})
    row = spark.range(1).select(fields.alias("f")).select("f.*").first()
    last = max((i for i, x in enumerate(row) if x is not None), default=-1)
    quoted = spark.read.option("header", True).option("sep", sep).csv(path)
    n = max(last + 1, len(quoted.columns))  # trailing empty names count as columns too
    return [(x or "").strip() for x in row[:n]]


def read_headered_csv(spark: SparkSession, path: str, dedup_case: bool = True) -> DataFrame:
    """S7+P4: headered CSV with inferred types; with ``dedup_case`` headers that differ only in case
    keep their first occurrence and all names are upper-cased.

    Spark renames case-clashing headers by position on read; the header as written is read
    separately so the first occurrence is chosen by its original name, without touching the
    session's case-sensitivity setting.
    """
    df = spark.read.option("header", True).option("inferSchema", True).csv(path)
    if not dedup_case:
        return df
    return dedup_columns_ci(df, read_header_names(spark, path))


def bulk_load_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = "|",
                        null_marker: str = "\\N", timestamp_format: str | None = None) -> DataFrame:
    """Delimited text into a declared schema, as a warehouse bulk load reads it.

    Quoting is off (a field starting with a double quote is plain text). ``null_marker`` is null, and so is an
    empty field of any type but text, where it is the empty string. ``timestamp_format`` applies to TIMESTAMP
    and TIMESTAMP_NTZ columns; use unpadded patterns (``M/d/yyyy H:mm:ss``) so both padded and unpadded stamps
    load. A line that ``bulk_load_with_rejects`` would reject fails the load, whichever columns the query
    reads: every line is judged in a generator, which neither column pruning nor a filter passes by.
    """
    judged = _judged_lines(spark, path, schema, sep, null_marker, timestamp_format)
    wrong = F.raise_error(F.concat(F.lit("MALFORMED_RECORD: "), F.col("reason"), F.lit(" in line: "), F.col("line")))
    return judged.select(F.inline(F.array(F.when(F.col("reason").isNull(), F.col("__row")).otherwise(wrong))))


def bulk_load_with_rejects(spark: SparkSession, path: str, schema: T.StructType, sep: str = "|",
                           null_marker: str = "\\N", timestamp_format: str | None = None) -> tuple[DataFrame, DataFrame]:
    """S8/S9 with a report: (rows loaded, rejects as (line, reason)).

    A line is rejected for its number of fields, for a field that does not fit its column's type (a decimal's
    digits, a VARCHAR's or CHAR's length), or for a null in a column declared not null; the reason names the
    first such column. The text is read once: what was found of each line is stored in the shared scratch
    folder, and both frames read that.
    """
    judged = _judged_lines(spark, path, schema, sep, null_marker, timestamp_format)
    staged = written(judged.select("__row", "reason", F.when(F.col("reason").isNotNull(), F.col("line")).alias("line")), "load")
    return (staged.where("reason is null").select("__row.*"), staged.where("reason is not null").select("line", "reason"))


def _judged_lines(spark: SparkSession, path: str, schema: T.StructType, sep: str, null_marker: str,
                  timestamp_format: str | None) -> DataFrame:
    """(line, __row, reason) of each line: its typed fields, and why it can't be loaded (null if it can)."""
    # a separator of one character, escaped where it has a meaning in patterns, is split without a pattern
    pattern = ("\\" + sep if sep in ".$|()[{^?*+\\" else sep) if len(sep) == 1 else "\\Q" + sep + "\\E"
    lines = spark.read.text(path).select(F.col("value").alias("line"))
    parts = lines.select("line", F.split("line", pattern, -1).alias("parts"))

    def given(f: T.StructField, i: int) -> Column:
        text = F.get("parts", F.lit(i))
        return F.when(text != null_marker, text) if _is_text(f) else F.when((text != null_marker) & (text != ""), text)

    def value(f: T.StructField, i: int) -> Column:
        text = given(f, i)
        if isinstance(f.dataType, (T.VarcharType, T.CharType)):
            return F.when(F.length(text) <= f.dataType.length, text)
        if isinstance(f.dataType, T.StringType):
            return text
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)) and timestamp_format:
            return F.try_to_timestamp(text, F.lit(timestamp_format)).cast(f.dataType)
        if isinstance(f.dataType, T.DecimalType):  # the type's digits hold the value as written, not a rounded one
            exact = text.try_cast(T.DecimalType(38, 18))
            fits = exact.try_cast(f.dataType)
            return F.when(fits.cast(T.DecimalType(38, 18)) == exact, fits)
        return text.try_cast(f.dataType)

    # the generator of one row keeps the typed fields from being worked out again wherever they are used
    typed = F.struct(*[value(f, i).alias(f.name) for i, f in enumerate(schema.fields)])
    rows = parts.select("line", "parts", F.explode(F.array(typed)).alias("__row"))
    why = F.when(F.size("parts") != len(schema.fields), F.concat(F.size("parts").cast("string"), F.lit(" fields")))
    for i, f in enumerate(schema.fields):
        empty = F.col("__row").getField(f.name).isNull()
        why = why.when(empty & given(f, i).isNotNull(), F.lit(f"{f.name}: not {f.dataType.simpleString()}"))
        if not f.nullable:
            why = why.when(empty, F.lit(f"{f.name}: null"))
    return rows.select("line", "__row", why.alias("reason"))


def _is_text(f: T.StructField) -> bool:
    return isinstance(f.dataType, (T.StringType, T.VarcharType, T.CharType))


def with_auto_timestamps(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text columns recognised as timestamps by trying the known formats in order."""
    return df.select(*[auto_timestamp(c).alias(c) if c in columns else F.col(c) for c in df.columns])


def inline_rows(spark: SparkSession, rows: Sequence[Sequence] | DataFrame, schema: T.StructType,
                defaults: Mapping[str, object] | None = None, full_schema: T.StructType | None = None) -> DataFrame:
    """Rows given for ``schema``'s columns; omitted columns of ``full_schema`` take their
    default (or null). An explicit null in a given column stays null."""
    df = rows if isinstance(rows, DataFrame) else spark.createDataFrame(list(rows), schema)
    if full_schema is None:
        return df
    defaults = dict(defaults or {})
    cols = []
    for f in full_schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(defaults.get(f.name)).cast(f.dataType).alias(f.name))
    return df.select(*cols)
