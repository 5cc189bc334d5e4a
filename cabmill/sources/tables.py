"""Scans with the declared schema, and what the catalog knows."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabmill.operators.quality import contract_violations
from cabmill.schemas import RAW_COLUMNS, RAW_TRIP


def scan(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """A raw trip table from files, under the declared schema; nothing is inferred."""
    return spark.read.schema(RAW_TRIP).format(file_format).load(path)


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """A raw trip table of the catalog; refused if it breaks the declared schema."""
    table = spark.table(name)
    problems = [v for v in contract_violations(table.schema, RAW_TRIP) if v[1]]
    if problems:
        raise ValueError(f"{name} breaks the source contract: {problems}")
    return table.select(*RAW_COLUMNS)


def namespaces(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW NAMESPACES")


def tables_in(spark: SparkSession, namespace: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {namespace}").selectExpr(
        "namespace", "tableName AS table_name"
    )


def schema_rows(frame: DataFrame) -> DataFrame:
    """The columns of a frame, (position, column_name, data_type, row_count): names and types
    from the metadata, and one count of the rows."""
    lines = ", ".join(
        f"{i}, '{f.name}', '{f.dataType.simpleString()}', _rows"
        for i, f in enumerate(frame.schema, 1)
    )
    return frame.agg(F.count(F.lit(1)).alias("_rows")).selectExpr(
        f"stack({len(frame.schema)}, {lines}) AS (position, column_name, data_type, row_count)"
    )
