"""Result contract used when results are compared with the SQL oracle.

Exact decimals are produced by the jobs; at the comparison boundary every
non-integral number is carried as DOUBLE rounded to 6 decimals and every
integral number as BIGINT, so both engines render the same values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DecimalType, DoubleType, FloatType, IntegerType, ShortType

REAL_DIGITS = 6


def comparable(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (DecimalType, DoubleType, FloatType)):
            c = F.round(c.cast("double"), REAL_DIGITS)
        elif isinstance(f.dataType, (IntegerType, ShortType, ByteType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)
