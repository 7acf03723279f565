"""Raw-table access for the metric jobs.

``RawTables`` is a lazy name -> DataFrame accessor. Two constructors:

* ``RawTables.parquet(spark, base)`` reads ``<base>/<table>`` parquet folders,
  the production layout (one folder per raw table);
* ``RawTables.testdata(spark, sf_dir)`` derives every raw table from the
  driver's TPC-H-like test tables through the SQL bindings in ``testdata``.

Frames are built on first use and cached per accessor, so a job that reads a
table twice shares one logical scan definition.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from . import testdata

RAW_TABLES = tuple(testdata.BINDINGS)
# Raw tables whose storage name differs from the name the jobs use.
STORAGE_NAMES = {"orders_raw": "orders"}


class RawTables:
    def __init__(self, spark: SparkSession, loader, label: str = ""):
        self.spark = spark
        self._loader = loader
        self._frames: dict[str, DataFrame] = {}
        self.label = label

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._loader(name)
        return self._frames[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self[name]

    @classmethod
    def parquet(cls, spark: SparkSession, base: str) -> "RawTables":
        return cls(spark, lambda n: spark.read.parquet(os.path.join(base, STORAGE_NAMES.get(n, n))), base)

    @classmethod
    def testdata(cls, spark: SparkSession, sf_dir: str) -> "RawTables":
        base = testdata.base_frames(spark, sf_dir)
        return cls(spark, lambda n: testdata.binding_frame(spark, n, base), sf_dir)
