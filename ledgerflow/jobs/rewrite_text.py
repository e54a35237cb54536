"""Read text lines, substitute the first match on each line, write lines.

The scheduled original writes a one-line file, rewrites it with ``sed`` and
prints the result. On Spark every line is a row, so the substitution is a
built-in ``regexp_replace`` on each row; the read and write are the text
source and sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.functions.scalars import replace_first_per_line
from ledgerflow.sources.files import read_lines, write_lines

# The line the extract step writes and the substitution.
EXTRACT_LINE = "raw_data=hello"
FIND = "hello"
REPLACE = "hello_airflow"


def extract(spark: SparkSession, path: str, lines: list[str] | None = None) -> None:
    """Write the extract file (the job's input)."""
    rows = [(x,) for x in (lines or [EXTRACT_LINE])]
    write_lines(spark.createDataFrame(rows, "value string").coalesce(1), path)


def transform(spark: SparkSession, src: str, dst: str, find: str = FIND, replace: str = REPLACE) -> DataFrame:
    out = read_lines(spark, src).select(replace_first_per_line("value", find, replace).alias("value"))
    write_lines(out, dst)
    return read_lines(spark, dst)


def run(spark: SparkSession, workdir: str) -> DataFrame:
    """extract >> transform >> load (the load step returns the written lines)."""
    raw = f"{workdir}/raw_txt"
    transformed = f"{workdir}/transformed_txt"
    extract(spark, raw)
    return transform(spark, raw, transformed)
