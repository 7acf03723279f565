"""Table sinks: full-overwrite parquet with the warehouse layout, and table registration.

``PARTITION BY col`` becomes a directory partition (static and dynamic
partition pruning on read). Rows are rebalanced on it, so that AQE gives a
small partition value one writer and splits a large one over many. ``CLUSTER
BY cols`` becomes a range over all cluster columns and a hash of the row, so
that few or hot cluster values still spread over many writers, and a sort
within each task: every file holds a compact key range and parquet min/max
statistics prune row groups on the cluster keys.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back: cuts lineage, and every
    later read sees the same rows in the same blocks."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_materialised(*tables: DataFrame) -> None:
    """Delete tables made by ``materialise`` that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_table(df: DataFrame, path: str, partition_by: str | None = None,
                cluster_by: tuple[str, ...] = (), mode: str = "overwrite") -> None:
    out = df
    if partition_by:
        out = out.hint("rebalance", F.col(partition_by))
    elif cluster_by:
        out = out.repartitionByRange(*cluster_by, F.xxhash64(*out.columns))
    if cluster_by:
        out = out.sortWithinPartitions(*([partition_by] if partition_by else []), *cluster_by)
    writer = out.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def write_ordered(df: DataFrame, path: str, order: list, mode: str = "overwrite") -> None:
    """CTAS with ORDER BY: files by ranges of ``order``, sorted inside, named in their order.

    Read in the order of their names (``ordered_files``) the files give the rows in
    order. A hash of the row ends the order, so rows equal in it still spread.
    """
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    out = df.withColumn("_row", F.xxhash64(*df.columns))
    out = out.repartitionByRange(*keys, F.col("_row")).sortWithinPartitions(*keys, F.col("_row"))
    out.drop("_row").write.mode(mode).parquet(path)


def ordered_files(spark: SparkSession, path: str) -> list[str]:
    """The files of an ordered table in the order of its rows."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    names = [x.getPath().toString() for x in listed if x.getPath().getName().startswith("part-")]
    return sorted(names, key=lambda n: n.rsplit("/", 1)[1])


def write_bucketed(df: DataFrame, table: str, path: str, keys: list[str], buckets: int) -> None:
    """Landing by buckets of ``keys``, sorted inside: joins and aggregations on the keys of tables
    with the same buckets need no shuffle. ``table`` is ``namespace.table``, its files lie at ``path``."""
    dealt = df.repartition(buckets, *keys)
    dealt.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)


def register_table(spark: SparkSession, namespace: str, name: str, path: str) -> None:
    """CREATE DATABASE / CREATE OR REPLACE of an external table over a written folder."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{namespace}`")
    spark.sql(f"DROP TABLE IF EXISTS `{namespace}`.`{name}`")
    spark.catalog.createTable(f"`{namespace}`.`{name}`", path=path, source="parquet")
    if any(c.isPartition for c in spark.catalog.listColumns(f"{namespace}.{name}")):
        spark.catalog.recoverPartitions(f"{namespace}.{name}")


def stored_table(spark: SparkSession, path: str) -> bool:
    """Whether a finished table lies at ``path`` (any file system Spark reaches)."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)
