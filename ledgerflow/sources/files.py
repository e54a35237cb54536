"""File sources and sinks: CSV feeds, text lines, partitioned appends
(S1-S3, S5-S7, S15)."""

from __future__ import annotations

import csv
from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Fixed value: the message for absent required columns.
MSG_MISSING = "CSV missing required columns: {}"

#: Column in which Spark keeps the whole record of a row with too few or too many fields.
_RECORD = "__record"


def string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def csv_headers(spark: SparkSession, paths: str | Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """The distinct headers of the CSV files below ``paths``, with their files.

    One job, however many files there are: the header is the first line that is not
    blank, found as the minimum position per file (a hash aggregate of numbers, so no
    line is sorted or shuffled) and read by a second scan that keeps those positions
    only. Both scans read lines without parsing them. A header must start in a file's
    first block; files without one are left out. The driver gets the list of files.
    """
    from ledgerflow.operators.merge import FILE_BLOCK, FILE_PATH, FILE_ROW, with_file_position

    lines = with_file_position(spark.read.text(paths))
    lines = lines.where((F.col(FILE_BLOCK) == 0) & (F.trim("value") != ""))
    first = lines.groupBy(FILE_PATH).agg(F.min(FILE_ROW).alias("_first")).select("_first")
    found = lines.join(first, F.col(FILE_ROW) == F.col("_first")).select("value", FILE_PATH)
    out: dict[tuple[str, ...], list[str]] = {}
    for line, file in sorted(found.collect(), key=lambda r: r[1]):
        out.setdefault(header_names(line), []).append(unquote(file))
    return out


def header_names(line: str) -> tuple[str, ...]:
    """Field names of a header line; empty and repeated ones are named by their place (the last of equal names keeps it)."""
    names = next(csv.reader([line.removeprefix("\ufeff")]))
    last = {n: i for i, n in enumerate(names)}
    return tuple(n if n and last[n] == i else f"_c{i}" for i, n in enumerate(names))


# A CSV field: quoted with doubled quotes inside, or plain.
_FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"|[^,"][^,]*+|)'


def surplus_fields(record: Column, n_fields: int) -> Column:
    """Fields of a CSV record beyond the first ``n_fields``, as an array; NULL if there are none."""
    rest = F.regexp_extract(record, f"(?s)^{_FIELD}(?:,{_FIELD}){{{n_fields - 1}}}(,.*)$", 1)
    fields = F.regexp_extract_all(rest, F.lit(f",({_FIELD})"), F.lit(1))
    plain = F.transform(fields, lambda f: F.when(f.startswith('"'), F.replace(f.substr(F.lit(2), F.length(f) - 2), F.lit('""'), F.lit('"'))).otherwise(f))
    return F.when(rest != "", plain)


def read_csv_strings(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    multi_line: bool = False,
    position: bool = False,
    surplus: str | None = None,
) -> DataFrame:
    """CSV files with a header row, every field kept as text (no inference).

    Fields are taken by the names in each file's own header, so files may differ
    in column order and may lack columns (NULL, which validation rejects).
    Quoted fields and doubled quotes are honoured, blank lines skipped; a short
    row gives NULL for its missing fields. ``multi_line`` allows line breaks in
    quoted fields (such files are not split). ``columns`` selects and orders the
    fields; by default they are those of any file, in order of appearance.
    ``position`` adds each row's place in its file (see ``with_file_position``).
    ``surplus`` names an array column for the fields of a row beyond its header
    (NULL if there are none): Spark keeps the whole record of a row whose length
    differs from the header's, and only such records are looked at again.
    """
    from ledgerflow.operators.merge import POSITION, with_file_position

    headers = csv_headers(spark, path)
    names = list(columns) if columns is not None else list(dict.fromkeys(c for h in headers for c in h))
    out = None
    for header, files in headers.items():
        fields = [*header, _RECORD] if surplus else header
        part = (
            spark.read.schema(string_schema(fields)).option("header", True).option("escape", '"')
            .option("columnNameOfCorruptRecord", _RECORD).option("multiLine", multi_line)
        )
        if surplus:  # a parser that skips unwanted fields does not see how many there are
            part = part.option("columnPruning", False)
        part = part.csv(files)
        if position:
            part = with_file_position(part)
        part = part.select(
            *[F.col(f"`{c}`") if c in header else F.lit(None).cast("string").alias(c) for c in names],
            *([surplus_fields(F.col(_RECORD), len(header)).alias(surplus)] if surplus else []),
            *(POSITION if position else []),
        )
        out = part if out is None else out.unionByName(part)
    if out is None:
        types = {POSITION[1]: T.LongType(), POSITION[2]: T.LongType()}
        extra = [T.StructField(surplus, T.ArrayType(T.StringType()))] if surplus else []
        extra += [T.StructField(c, types.get(c, T.StringType())) for c in (POSITION if position else [])]
        return spark.createDataFrame([], T.StructType([*string_schema(names).fields, *extra]))
    return out


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with declared column types (inference only when no schema is given)."""
    reader = spark.read.option("header", True).option("escape", '"')
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).option("enforceSchema", False).csv(path)


def require_columns(df: DataFrame, required: Iterable[str]) -> None:
    """S3: fail when a required column is missing; extra columns are allowed."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(MSG_MISSING.format(missing))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """A text file as one row per line (column ``value``)."""
    return spark.read.text(path)


def write_lines(df: DataFrame, path: str, column: str = "value") -> None:
    """Write one text line per row (overwrite)."""
    df.select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)


def append_partitioned(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Add rows to a partitioned table, replacing only the partitions
    present in ``df`` (so a retried run rewrites its own partitions)."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def replace_table(df: DataFrame, path: str) -> None:
    """Replace-load (``if_exists='replace'``)."""
    df.write.mode("overwrite").parquet(path)
