"""Whole numbers that order as doubles do, from arithmetic alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_HALF_SPAN = 2.0**537  # its square spans the smallest double to one, which is beyond a double
_FRACTION = 1 << 52


def with_double_key(df: DataFrame, value: str, out: str) -> DataFrame:
    """Adds a bigint that orders the doubles of ``value`` as Spark does: ascending, both zeros equal, NaN after all; NULL stays NULL.

    It is the double's bit pattern, negated for negative numbers: exponent above, 52 bits of fraction below.  Each step is a
    projection of its own, so that a logarithm and a power are computed once for each value.
    """
    v, a, low = F.col(value), F.col("__a"), F.col("__low")
    steps = df.withColumn("__a", F.abs(v)).withColumn("__near", F.when(a < float("inf"), F.least(F.floor(F.log2("__a")).cast("int"), F.lit(1023))))
    # One off at most, next to a power of two.
    steps = steps.withColumn("__low", F.pow(F.lit(2.0), "__near"))
    steps = steps.withColumn("__off", F.when(low > a, -1).when(a >= low * 2, 1).otherwise(0))
    unit = F.when(F.col("__off") == 0, low).when(F.col("__off") > 0, low * 2).otherwise(low / 2)
    normal = (F.col("__near") + F.col("__off") + 1023).cast("bigint") * _FRACTION + ((a / unit - 1) * float(_FRACTION)).cast("bigint")
    tiny = (a * _HALF_SPAN * _HALF_SPAN).cast("bigint")
    top = F.lit(2047 * _FRACTION)
    bits = F.when(F.isnan(a), top + 1).when(a == float("inf"), top).when(a == 0, F.lit(0).cast("bigint")).when(a < 2.0**-1022, tiny).otherwise(normal)
    steps = steps.withColumn("__bits", bits)
    key = F.when(v.isNotNull(), F.when(v < 0, -F.col("__bits")).otherwise(F.col("__bits")))
    return steps.withColumn(out, key).drop("__a", "__near", "__low", "__off", "__bits")


def double_of_key(key: Column) -> Column:
    """The double that `with_double_key` made the key of."""
    bits = F.abs(key)
    e, fraction = F.shiftright(bits, 52).cast("int"), bits.bitwiseAND(F.lit(_FRACTION - 1)).cast("double")
    normal = (fraction / float(_FRACTION) + 1) * F.pow(F.lit(2.0), e - 1023)
    a = F.when(e == 2047, F.when(fraction > 0, float("nan")).otherwise(float("inf"))).when(e == 0, fraction / _HALF_SPAN / _HALF_SPAN).otherwise(normal)
    return F.when(key < 0, -a).otherwise(a)
