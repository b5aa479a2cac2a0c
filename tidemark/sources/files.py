"""Feed files and plain table folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import freed_shuffles

CORRUPT = "_corrupt_record"
# CSV text of zone-free timestamps; Spark's own default stops at milliseconds.
MICROSECONDS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def read_csv_feed(
    spark: SparkSession, path: str, schema: T.StructType, keep_corrupt: bool = False
) -> DataFrame:
    """Header CSV, bound to the declared columns by name; no pass over the rows to infer types.

    All files must have the same header. A column that it lacks is NULL, as is a field that does not
    parse; `keep_corrupt` adds the text of rows with such a field.
    """
    raw = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    return typed(raw, schema, keep_corrupt)


def typed(raw: DataFrame, schema: T.StructType, keep_corrupt: bool = False) -> DataFrame:
    """Text columns as the declared ones, found by name."""
    columns, bad = [], F.lit(False)
    for field in schema.fields:
        if field.name not in raw.columns:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        value = F.col(field.name).try_cast(field.dataType)
        bad = bad | (F.col(field.name).isNotNull() & value.isNull())
        columns.append(value.alias(field.name))
    if keep_corrupt:
        text = F.concat_ws(",", *[F.coalesce(F.col(name), F.lit("")) for name in raw.columns])
        columns.append(F.when(bad, text).alias(CORRUPT))
    return raw.select(*columns)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.option("header", True).option("timestampNTZFormat", MICROSECONDS).mode(mode).csv(path)
    return path


def append_run(df: DataFrame, path: str, by: str) -> str:
    """Append rows under their run partition; writing a run again replaces just that run."""
    with freed_shuffles(df.sparkSession):
        (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(by)
            .parquet(path)
        )
    return path
