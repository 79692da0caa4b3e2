"""Readers and writers for property tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelry.contract import TARGET
from parcelry.functions.columns import named, nan_to_null

# Texts that stand for a missing value in CSV files.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

_CSV = {
    "header": "true",
    "escape": '"',
    "emptyValue": "",
    "nullValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def scan_priced(df: DataFrame, price: str = TARGET) -> DataFrame:
    """Rows that have a price. The test on the raw column reaches the file scan."""
    x = named(price)
    return nan_to_null(df.filter(x.isNotNull() & ~F.isnan(x.cast("double"))))


def scan_positive_priced(df: DataFrame, price: str = TARGET) -> DataFrame:
    """Rows with a price above zero."""
    x = named(price)
    return nan_to_null(df.filter(x.isNotNull() & (x > 0) & ~F.isnan(x.cast("double"))))


def jdbc_options(
    url: str,
    table: str,
    driver: str | None = None,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    fetch_rows: int = 10_000,
) -> dict[str, str]:
    """Options of a JDBC read. The bounds only place the partition borders; without a partition column
    one task reads the whole table, which suits small ones.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_rows), **(properties or {})}
    if driver:
        options["driver"] = driver
    if partition_column:
        if bounds is None:
            raise ValueError("a partitioned JDBC read needs bounds")
        options.update(
            partitionColumn=partition_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(partitions),
        )
    return options


def read_jdbc(spark: SparkSession, one_task: bool = False, **settings) -> DataFrame:
    """Property table over JDBC. The caller supplies the driver jar and the credentials.

    A read without a partition column goes through a single task, so it must be asked for.
    """
    if not settings.get("partition_column") and not one_task:
        raise ValueError("Name a partition_column, its bounds and the partitions, or ask for one_task if the table is small")
    return spark.read.format("jdbc").options(**jdbc_options(**settings)).load()


def run_sql(spark: SparkSession, query: str, params: dict | None = None, **tables: DataFrame) -> DataFrame:
    """Run a query whose :name markers are bound to values, never spliced into the text.

    {name} in the query stands for the DataFrame passed under that name.
    """
    return spark.sql(query, args=params or {}, **tables)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """CSV with a header and a declared schema.

    The header must name the columns in schema order. Missing-value texts become NULL; any
    other text that does not fit its column fails the job, and NaN never enters the table.
    Fields that contain line breaks need multi_line, which keeps a file in one task.
    """
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    reader = spark.read.options(**_CSV).option("enforceSchema", "false").option("multiLine", multi_line)
    raw = reader.schema(as_text).csv(path)
    columns = []
    for f in schema:
        text = F.when(~named(f.name).isin(MISSING_TEXTS), named(f.name))
        columns.append(text.cast(f.dataType).alias(f.name))
    return raw.select(*columns)


def store_extract(df: DataFrame, path: str, file_format: str = "parquet") -> DataFrame:
    """Write a table and return it as read back, so that later passes see fixed rows.

    Parquet lets those passes read single columns; CSV has them read every byte.
    """
    if file_format == "csv":
        # text may hold line breaks; each write task's file is read by one task
        return read_csv(df.sparkSession, write_csv(df, path), df.schema, multi_line=True)
    df.write.mode("overwrite").format(file_format).save(path)
    return df.sparkSession.read.format(file_format).schema(df.schema).load(path)


def write_csv(df: DataFrame, path: str) -> str:
    """Write a folder of CSV files with headers, one per task."""
    df.write.mode("overwrite").options(**_CSV).csv(path)
    return path
