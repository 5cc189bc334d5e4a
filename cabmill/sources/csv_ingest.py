"""Batch ingest of raw trip CSV files against the declared schema.

    spark-submit cabmill/sources/csv_ingest.py --source /in --target /lake/raw [--prefix 2015]

prints a line per file and the totals, and exits with 1 if a file failed.
"""

import argparse
import sys
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from cabmill.schemas import RAW_COLUMNS, RAW_TRIP
from cabmill.sources.shared import Scratch, child_folders, remove, replace_folder

_CORRUPT = "_corrupt_record"
SUCCESS, BAD_LINES, WRONG_HEADER = "success", "bad lines", "wrong header"
# The raw table: a partition per source file, bad lines beside the good rows.
_STORED = StructType(
    [
        *RAW_TRIP,
        StructField(_CORRUPT, StringType()),
        StructField("accepted", BooleanType()),
        StructField("line", LongType()),
        StructField("at_start", BooleanType()),
        StructField("source_file", StringType()),
    ]
)


def list_csv(spark: SparkSession, directory: str, prefix: str = "") -> DataFrame:
    """The CSV files of one directory, (source_file, bytes); contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"{prefix}*.csv")
        .load(directory)
        .select(F.col("path"), F.col("length").alias("bytes"))
    )
    return files.select(_file_name(F.col("path")).alias("source_file"), "bytes")


def _file_name(path):
    return F.url_decode(F.element_at(F.split(path, "/"), -1))


def read_lines(spark: SparkSession, directory: str, prefix: str = "") -> DataFrame:
    """Typed rows of all lines of all files, headers included, in one distributed read.

    A line that does not fit the schema, as a header does not, keeps its text in
    `_corrupt_record`. `line` ascends within a file's first block, of which `at_start` is true.
    """
    with_corrupt = StructType([*RAW_TRIP, StructField(_CORRUPT, StringType())])
    return (
        spark.read.schema(with_corrupt)
        .option("header", False)
        .option("enforceSchema", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]")
        .option("pathGlobFilter", f"{prefix}*.csv")
        .csv(directory)
        .withColumn("accepted", F.col(_CORRUPT).isNull())
        .withColumn("line", F.monotonically_increasing_id())
        .withColumn("at_start", F.col("_metadata.file_block_start") == 0)
        .withColumn("source_file", _file_name(F.col("_metadata.file_path")))
        .select(*_STORED.names)
    )


def _is_header(text):
    """Whether a line names the declared columns, ignoring case, quotes and blanks."""
    return F.regexp_replace(F.lower(text), r'["\s\x{FEFF}]', "") == ",".join(RAW_COLUMNS)


def _first_lines(stored: DataFrame) -> DataFrame:
    """(source_file, first_line, header): the place of a file's first line, and its text if that
    is no row. A header further down is an ordinary bad line."""
    return stored.where("at_start").groupBy("source_file").agg(
        F.min("line").alias("first_line"), F.min_by(_CORRUPT, "line").alias("header")
    )


def ingest_csv(spark: SparkSession, directory: str, target: str, prefix: str = "") -> DataFrame:
    """Load all CSV files of a directory into a raw table and report per file.

    The files are read once: all lines are parsed into a folder per file beside the table, and
    the folders of the files that begin with the declared header move into the table. Loading a
    file again replaces its rows, and files of earlier loads stay. A file without the header loads
    nothing; of a file with bad lines the good rows load, and the bad lines are kept beside them.
    Either counts as failed.

    (source_file, bytes, row_count, corrupt_rows, status)
    """
    staging = f"{target.rstrip('/')}/_loading-{uuid.uuid4().hex}"
    try:
        read_lines(spark, directory, prefix).write.partitionBy("source_file").parquet(staging)
        with Scratch(spark, "csv-load") as scratch:
            stored = spark.read.schema(_STORED).parquet(staging)
            counts = stored.groupBy("source_file").agg(
                F.count("*").alias("lines"), F.count_if(~F.col("accepted")).alias("bad")
            )
            loads = scratch.written(
                counts.join(_first_lines(stored), "source_file", "left").select(
                    "source_file", "lines", "bad", F.coalesce(_is_header(F.col("header")), F.lit(False)).alias("headed")
                ),
                keep=True,
            )
            moved = [r.source_file for r in loads.where("headed").select("source_file").toLocalIterator()]
            names = {_file_of(f): f for f in child_folders(spark, staging)}
            for name in moved:
                replace_folder(spark, f"{staging}/{names[name]}", f"{target.rstrip('/')}/{names[name]}")
    finally:
        remove(spark, staging)
    return _report(list_csv(spark, directory, prefix), loads)


def _file_of(folder: str) -> str:
    """The file name that a partition folder stands for."""
    return unquote(folder.split("=", 1)[-1])


def _report(files: DataFrame, loads: DataFrame) -> DataFrame:
    """Per file what a load made of it; the header is no row."""
    headed = F.coalesce("headed", F.lit(False))
    status = (
        F.when(~headed & (F.col("bytes") > 0), WRONG_HEADER)
        .when(headed & (F.col("bad") > 1), BAD_LINES)
        .otherwise(SUCCESS)
    )
    beyond = lambda c: F.when(headed, F.col(c) - 1).otherwise(0)
    return files.join(loads, "source_file", "left").select(
        "source_file", "bytes", beyond("lines").alias("row_count"),
        beyond("bad").alias("corrupt_rows"), status.alias("status"),
    ).orderBy("source_file")


def load_totals(report: DataFrame) -> DataFrame:
    """One row: files seen, loaded without a bad line, and failed."""
    good = F.count_if(F.col("status") == SUCCESS)
    return report.agg(
        F.count(F.lit(1)).alias("total"),
        good.alias("success"),
        (F.count(F.lit(1)) - good).alias("failed"),
    )


def accepted_rows(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.schema(_STORED).parquet(target).where("accepted").select(*RAW_COLUMNS)


def rejected_lines(spark: SparkSession, target: str) -> DataFrame:
    """(source_file, line): the text of every bad line of the loaded files."""
    stored = spark.read.schema(_STORED).parquet(target)
    firsts = _first_lines(stored).withColumnRenamed("source_file", "f")
    is_first = (F.col("source_file") == F.col("f")) & (F.col("line") == F.col("first_line"))
    rows = stored.where("NOT accepted").join(firsts, is_first, "left_anti")
    return rows.select("source_file", F.col(_CORRUPT).alias("line"))


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Load the CSV files of a directory")
    parser.add_argument("--source", required=True)
    parser.add_argument("--target", required=True)
    parser.add_argument("--prefix", default="")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("cabmill-ingest").getOrCreate()
    report = ingest_csv(spark, args.source, args.target, args.prefix)
    for r in report.toLocalIterator():
        print(f"{r.source_file}: {r.row_count} rows, {r.corrupt_rows} unreadable, {r.status}")
    totals = load_totals(report).first()
    print(f"total {totals.total}, success {totals.success}, failed {totals.failed}")
    return int(totals.failed > 0)


if __name__ == "__main__":
    sys.exit(main())
