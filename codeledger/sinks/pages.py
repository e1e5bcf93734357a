"""Pages of a table in key order, read by range: page 1,000 costs what page 1 costs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from codeledger.session import checkpointed

PART = "_part"
#: Rows of a part: a page reads the parts that it touches, whole.
PART_ROWS = 100_000


@dataclass(frozen=True)
class PagedTable:
    """A table stored in parts of consecutive keys, and the number of rows of each part.

    ``bounds`` has a row per part, (_part, rows), in order: two numbers per 100,000 rows, which is what the
    driver reads to find a page.
    """

    spark: SparkSession
    path: str
    schema: StructType
    key: str
    bounds: DataFrame

    def page(self, offset: int, limit: int) -> DataFrame:
        """Rows ``offset`` to ``offset + limit`` in key order.  Rows of equal keys have no order among each other."""
        start, touched, before = 0, [], None
        for row in self.bounds.orderBy(PART).toLocalIterator():
            if start < offset + limit and start + row["rows"] > offset:
                touched.append(row[PART])
                before = start if before is None else before
            start += row["rows"]
        if not touched:
            return self.spark.createDataFrame([], self.schema)
        # these folders only: the others are not even listed
        rows = self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{PART}={part}" for part in touched])
        return rows.orderBy(self.key).offset(max(0, offset - before)).limit(limit)


def paged(df: DataFrame, path: str, key: str = "repo_id", part_rows: int = PART_ROWS) -> PagedTable:
    """Store ``df`` under ``path`` for paging by ``key``: one range shuffle, then a folder per part.

    Keys should be unique, as ``repo_id`` is in the inventory; a null key comes first.  Rows of one key stay together, so a
    key with very many rows makes a large part, not a wrong page.
    """
    spark = df.sparkSession
    parts = max(1, -(-df.count() // part_rows))
    path = path.rstrip("/")
    dealt = df.repartitionByRange(parts, key).withColumn(PART, F.spark_partition_id())
    dealt.write.partitionBy(PART).parquet(path)
    stored = spark.read.schema(f"{PART} int").parquet(path)
    bounds = checkpointed(stored.groupBy(PART).agg(F.count(F.lit(1)).alias("rows")))
    return PagedTable(spark, path, df.schema, key, bounds)
