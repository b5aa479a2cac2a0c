"""Key logs: small rows that are found by key without reading what they stand for."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = "bucket"


@dataclass(frozen=True)
class KeyLog:
    """Rows of a key column and others, run by run, in one folder for each bucket of the key's hash.

    A lookup opens the folders of the buckets its keys fall into and no others; within them, files
    hold a Bloom filter of the key for filters by value. Appending a run again replaces what it
    wrote into the same buckets.
    """

    path: str
    key: str
    buckets: int = 64

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def append(self, rows: DataFrame, run_id: str) -> None:
        """The rebalance joins small buckets into few tasks, so that a run adds about one file to a bucket."""
        placed = rows.withColumns({BUCKET: self.bucket(), "run_id": F.lit(run_id)})
        (
            placed.hint("rebalance", BUCKET)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option(f"parquet.bloom.filter.enabled#{self.key}", "true")
            .option("parquet.bloom.filter.adaptive.enabled", "true")
            .partitionBy(BUCKET, "run_id")
            .parquet(self.path)
        )

    def read(self, spark: SparkSession, schema: T.StructType, buckets: Iterable[int]) -> DataFrame | None:
        """Rows with their run from the given buckets; None while there are no such folders."""
        wanted = ",".join(str(n) for n in sorted(buckets))
        kinds = [*schema.fields, T.StructField(BUCKET, T.IntegerType()), T.StructField("run_id", T.StringType())]
        reader = spark.read.schema(T.StructType(kinds)).option("basePath", self.path)
        try:
            return reader.parquet(f"{self.path}/{BUCKET}={{{wanted}}}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def exists(self, spark: SparkSession, schema: T.StructType) -> bool:
        return self.read(spark, schema, range(self.buckets)) is not None


def same_keys(rows: DataFrame, known: DataFrame, columns: list[str], how: str) -> DataFrame:
    """Semi or anti join on columns in which NULL equals NULL."""
    lookup = known.select(*[F.col(c).alias(f"_known_{c}") for c in columns])
    equal = F.lit(True)
    for c in columns:
        equal = equal & F.col(c).eqNullSafe(F.col(f"_known_{c}"))
    return rows.join(lookup, equal, how)
