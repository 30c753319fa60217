"""Line-oriented text sources: ordered lines, sectioned files, positional comma records.

File order is kept by a key taken in the scan's own projection, before any filter or shuffle:
(file path, split start, monotonically increasing id). Carry-forward of section headers then runs
as an ordered scan (range partitioned, see ``operators.ordered``), so one huge file is processed by
many tasks and many small files by many tasks as well.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from kestrel.functions.text import after_first_colon, safe_double, split_fields, strip_quotes, ustrip
from kestrel.operators.ordered import fill_forward

# Layout of the hourly wide tables.
HOUR_PREFIX = "Hora_"
N_HOURS = 24
FILE_COL, BLOCK_COL, LINE_COL = "file_path", "block_start", "line_id"


def hour_columns(n: int = N_HOURS, prefix: str = HOUR_PREFIX) -> list[str]:
    return [f"{prefix}{i}" for i in range(1, n + 1)]


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Every line of the files with its file-order key and the stripped text in ``line``.

    Line ends are LF, CRLF or CR; all Unicode white space is stripped at both ends.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    raw = spark.read.text(paths)
    return raw.select(
        F.col("_metadata.file_path").alias(FILE_COL),
        F.col("_metadata.file_block_start").alias(BLOCK_COL),
        F.monotonically_increasing_id().alias(LINE_COL),
        ustrip("value").alias("line"),
    )


def attach_sections(lines: DataFrame, header_prefix: str, keys: Sequence[str] = (FILE_COL,),
                    order: Sequence[str] = (BLOCK_COL, LINE_COL), line_col: str = "line",
                    section_col: str = "section", columns: Sequence[str] | None = None) -> DataFrame:
    """Header lines (``header_prefix``, any case) set the section of the lines after them.

    The section is the header text after its first colon, stripped. Lines before any header get
    null. Header lines themselves are removed from the output. ``columns`` are those of ``lines`` to
    return (all by default); the scan stores no others but the keys and the order.
    """
    line = F.col(line_col)
    is_header = F.upper(line).startswith(header_prefix.upper())
    tagged = lines.withColumn("__is_header", is_header).withColumn(
        "__header", F.when(F.col("__is_header"), after_first_colon(line)))
    wanted = lines.columns if columns is None else list(columns)
    tagged = tagged.select(*dict.fromkeys([*wanted, *keys, *order]), "__is_header", "__header")
    carried = fill_forward(tagged, list(keys), list(order), "__header", section_col)
    return carried.filter(~F.col("__is_header")).select(*wanted, section_col)


def typed_record_filter(line: Column, parts: Column, record_type: str = "D", n_values: int = N_HOURS) -> Column:
    """S3: all three tests of a typed record: ``,<sp>TYPE<sp>,`` somewhere (case-sensitive), at least
    2 + n_values comma fields, and field 1 stripped and upper-cased equal to TYPE."""
    token = re.escape(record_type)
    return (line.rlike(rf"(?U),\s*{token}\s*,")
            & (F.size(parts) >= 2 + n_values)
            & (F.upper(ustrip(F.get(parts, 1))) == record_type.upper()))


def hour_values(df: DataFrame, parts: str, start: int, n: int = N_HOURS, prefix: str = HOUR_PREFIX,
                keep: Sequence[str] = (), clean=ustrip) -> DataFrame:
    """Fields start..start+n-1 as safe doubles named Hora_1..Hora_n (extra fields ignored).

    The values are converted as one array and handed on by a one-row generator: a filter on the
    columns above stays above, instead of being pushed down with a copy of every conversion.
    """
    numbers = F.transform(F.slice(parts, start + 1, n), lambda x: safe_double(clean(x)))
    staged = df.select(*keep, F.explode(F.array(numbers)).alias("__values"))
    return staged.select(*keep, *[F.get(F.col("__values"), i).alias(f"{prefix}{i + 1}") for i in range(n)])


def parse_typed_records(lines: DataFrame, record_type: str = "D", line_col: str = "line",
                        keep: Sequence[str] = (), plant_col: str = "Planta",
                        n_values: int = N_HOURS) -> DataFrame:
    """S3+S4: typed records as (keep..., Planta, Hora_1..Hora_n)."""
    staged = lines.select(*keep, ustrip(line_col).alias("__line"))
    staged = staged.select(*keep, "__line", split_fields("__line", ",").alias("__parts"))
    records = staged.filter(typed_record_filter(F.col("__line"), F.col("__parts"), record_type, n_values))
    records = records.select(*keep, ustrip(F.get(F.col("__parts"), 0)).alias(plant_col), "__parts")
    return hour_values(records, "__parts", 2, n_values, keep=[*keep, plant_col])


def read_sectioned_offers(spark: SparkSession, paths, header_prefix: str = "AGENTE:",
                          record_type: str = "D") -> DataFrame:
    """S1-S4 end to end: (Agente, Planta, Hora_1..Hora_24) from sectioned offer files."""
    sections = attach_sections(read_lines(spark, paths), header_prefix, section_col="Agente")
    return parse_typed_records(sections, record_type, keep=["Agente"])


def parse_declarations(lines: DataFrame, line_col: str = "line", key_col: str = "Central",
                       n_values: int = N_HOURS, total_label: str = "TOTAL",
                       keep: Sequence[str] = ()) -> DataFrame:
    """Headerless ``key, v1..vn`` records: blank lines skipped, each field stripped then freed of
    surrounding double quotes (no quote-aware parsing), at least n+1 fields, the ``TOTAL`` row
    (any case) skipped, values as safe doubles."""
    staged = lines.select(*keep, ustrip(line_col).alias("__line"))
    staged = staged.filter(F.col("__line") != "").select(*keep, split_fields("__line", ",").alias("__raw"))
    staged = staged.filter(F.size("__raw") >= 1 + n_values)
    staged = staged.select(*keep, strip_quotes(F.get(F.col("__raw"), 0)).alias(key_col), "__raw")
    staged = staged.filter(F.upper(key_col) != total_label.upper())
    return hour_values(staged, "__raw", 1, n_values, keep=[*keep, key_col], clean=lambda x: ustrip(strip_quotes(x)))


def read_declarations(spark: SparkSession, paths, **kw) -> DataFrame:
    """S1+S5 from files."""
    return parse_declarations(read_lines(spark, paths), **kw)
