"""Readers and writers for the three inputs and the report.

Delimited files are read with every column as text (no inference pass over
the data, account numbers keep their leading zeros); typed casts happen in the
prepare operators.  Parquet is read as is, with pushdown.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.sequence import sequence_from_files

# The column names each input file must carry.
CUSTOMER_COLUMNS = ("CustomerName", "AccountNumber", "Amount")
LEDGER_COLUMNS = (
    "AccountNumber", "Date", "Type", "Amount", "TransactionNumber", "OpeningBalance", "ClosingBalance",
)
MAPPING_COLUMNS = ("AccountNumber", "Date", "TransactionNumber")


#: What a CSV input's values may look like: quoted with doubled quotes inside (fixed values).
QUOTE = '"'


def _format_of(spark: SparkSession, path: str, fmt: str | None) -> str:
    if fmt:
        return fmt
    name = path.lower().rstrip("/")
    if name.endswith(".parquet"):
        return "parquet"
    for packed in (".gz", ".bz2", ".zst"):
        name = name.removesuffix(packed)
    if name.endswith((".csv", ".txt", ".tsv")):
        return "csv"
    # A path without a telling ending: Parquet where its files are, else delimited text.
    files = spark.read.text(path).inputFiles()
    return "parquet" if files and all(f.lower().endswith(".parquet") for f in files) else "csv"


def broken_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, lines): files with lines that hold an odd number of quotes, where a quoted value goes on in the next line.

    Every quoted value closes where it opened, and quotes inside are doubled,
    so a record that ends with its line has an even number of quotes.  The text
    is read in splits of any size: each line is judged by itself.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))
    return lines.where(quotes % 2 == 1).groupBy("file").agg(F.count(F.lit(1)).alias("lines"))


def _read_csv(spark: SparkSession, path: str, multi_line: bool | None) -> DataFrame:
    # Without inferSchema every column is read as STRING: no inference pass
    # over the data, and account numbers keep their leading zeros.
    sep = "\t" if ".tsv" in path.lower().rstrip("/").rpartition("/")[2] else ","
    if multi_line is None:
        multi_line = broken_lines(spark, path).limit(1).count() > 0
    options = {"header": True, "inferSchema": False, "multiLine": multi_line, "sep": sep, "quote": QUOTE, "escape": QUOTE}
    return spark.read.options(**options).csv(path)


def read_input(
    spark: SparkSession, path: str, columns: Sequence[str], fmt: str | None = None, multi_line: bool | None = None
) -> DataFrame:
    """Read one input table; CSV with header and an all-text schema.

    The format follows the path's ending (csv, txt, tsv, packed or not, parquet)
    unless ``fmt`` names it; any other path is Parquet if its files are, else
    CSV.  ``multi_line``: whether quoted CSV values hold line breaks.  Files
    that do are read in one task each, others are split; by default the lines
    are looked through for open quotes first (``broken_lines``, one parallel
    pass over the text), so no record is ever cut in two.
    """
    fmt = _format_of(spark, path, fmt)
    if fmt == "csv":
        df = _read_csv(spark, path, multi_line)
    elif fmt == "parquet":
        df = spark.read.parquet(path)
    else:
        raise ValueError(f"unsupported input format {fmt!r}; workbooks must be exported to CSV or Parquet")
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{path}: missing columns {missing}")
    return df


def read_customers(spark: SparkSession, path: str, fmt: str | None = None, multi_line: bool | None = None) -> DataFrame:
    return read_input(spark, path, CUSTOMER_COLUMNS, fmt, multi_line)


def read_ledger(spark: SparkSession, path: str, fmt: str | None = None, multi_line: bool | None = None) -> DataFrame:
    return read_input(spark, path, LEDGER_COLUMNS, fmt, multi_line)


def read_mappings(spark: SparkSession, path: str, fmt: str | None = None, multi_line: bool | None = None) -> DataFrame:
    return read_input(spark, path, MAPPING_COLUMNS, fmt, multi_line)


def read_batches(spark: SparkSession, paths: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """Many Parquet result folders as one table (union-all by name).

    With the results' ``schema`` no footer is read, and folders without rows
    give an empty table.
    """
    if not paths:
        raise ValueError("no batch paths given")
    if schema is not None:
        return spark.read.schema(schema).parquet(*paths)
    return spark.read.option("mergeSchema", True).parquet(*paths)


def write_batches(rows: DataFrame, by: str, path: str) -> None:
    """Results kept per batch: a Parquet folder for each value of the column ``by`` (the caller's, of few values)."""
    rows.write.partitionBy(by).parquet(path)


def report_text(df: DataFrame) -> DataFrame:
    """Report columns as text: money with two decimals, never ``1.0E7``."""
    cols = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            # What no decimal holds (infinity, 1e37) keeps the double's own text.
            c = F.when(F.isnan(c), F.lit("NaN")).otherwise(F.coalesce(c.try_cast("decimal(38,2)").cast("string"), c.cast("string")))
        elif not isinstance(field.dataType, T.StringType):
            c = c.cast("string")
        else:
            c = F.nullif(c, F.lit(""))
        cols.append(c.alias(field.name))
    return df.select(*cols)


def write_report_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a report as a folder of CSV parts with a header.

    Text may hold newlines (per-account lists), so values are quoted and the
    folder must be read back with ``multiLine``.
    """
    (
        report_text(df)
        .write.mode(mode)
        .option("header", True)
        .option("quoteAll", True)
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_report_csv(spark: SparkSession, path: str, row: str | None = None) -> DataFrame:
    """The report as text; ``row`` names a column to add that numbers its rows as they were written.

    The sink's part files are named in the order of the sorted result's
    partitions, and a part with line breaks in its values is read in one task.
    """
    report = spark.read.option("header", True).option("multiLine", True).csv(path)
    return sequence_from_files(report, row) if row else report
