"""Table scans: parquet folders or JDBC relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, source: str | dict[str, str], schema: str | None = None) -> DataFrame:
    """A parquet path, or JDBC options (``url``, ``dbtable``, ``partitionColumn``, ...).

    Filters and column selection reach either scan; there is no paging, the
    scan is already split into partitions.
    """
    if isinstance(source, dict):
        return spark.read.format("jdbc").options(**source).load()
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(source)


def spread(scan: DataFrame) -> DataFrame:
    """A file scan over at least as many partitions as there are cores.

    For jobs that do much work per row on an input of few, unsplittable files.
    A large table has more splits than cores and passes unchanged, without a
    shuffle.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)
