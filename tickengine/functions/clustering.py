"""Values that order rows by several columns at once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Rows drawn per boundary of a text column.
_DRAWN = 100


def text_boundaries(df: DataFrame, column: str, parts: int) -> list[str]:
    """At most ``parts`` - 1 texts that cut a column evenly, from a bounded sample of it."""
    n = df.filter(F.col(column).isNotNull()).count()
    share = min(1.0, _DRAWN * parts / n) if n else 0.0
    drawn = df.select(column).filter(F.col(column).isNotNull())
    if share < 1.0:
        drawn = drawn.sample(share, seed=1)
    texts = sorted((r[0] for r in drawn.collect()), key=str.encode)
    cuts = {texts[len(texts) * i // parts] for i in range(1, parts)} if texts else set()
    return sorted(cuts, key=str.encode)


def text_rank(column: Column, cuts: list[str]) -> Column:
    """How many boundaries a text reaches, by bisection over whole texts."""

    def rank(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(column < F.lit(cuts[middle]), rank(low, middle)).otherwise(rank(middle + 1, high))

    return F.when(column.isNotNull(), rank(0, len(cuts)))


def as_number(df: DataFrame, column: str, parts: int) -> Column:
    """A column as a DOUBLE in the same order; text as its rank among boundaries."""
    c, data_type = F.col(column), df.schema[column].dataType
    if isinstance(data_type, T.StringType):
        return text_rank(c, text_boundaries(df, column, parts)).cast("double")
    if isinstance(data_type, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    return c.cast("double")


def interleave(buckets: list[Column], bits: int) -> Column:
    """Bits of several bucket numbers woven into one number (Morton order)."""
    width = len(buckets)
    parts = [
        F.shiftleft(
            F.shiftright(bucket.cast("long"), bit).bitwiseAND(F.lit(1)), bit * width + place
        )
        for bit in range(bits)
        for place, bucket in enumerate(buckets)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def with_z_value(
    df: DataFrame, columns: list[str], *, bits: int = 8, name: str = "_z"
) -> DataFrame:
    """Add the Morton order of ``columns``, each cut into ``2**bits`` quantile buckets.

    The quantiles come from Spark's own distributed sketch; only ``2**bits``
    boundaries per column reach the driver. A column with few distinct values has
    fewer buckets; their numbers are spread over the whole range, so that its bits
    weigh as much as those of the other columns.
    """
    from pyspark.ml.feature import QuantileDiscretizer

    numbers = [f"_n{i}" for i in range(len(columns))]
    buckets = [f"_b{i}" for i in range(len(columns))]
    staged = df.withColumns(
        {n: as_number(df, c, 2**bits) for n, c in zip(numbers, columns)}
    )
    discretizer = QuantileDiscretizer(
        numBucketsArray=[2**bits - 1] * len(columns),
        inputCols=numbers,
        outputCols=buckets,
        relativeError=1.0 / 2 ** (bits + 1),
        handleInvalid="keep",
    )
    model = discretizer.fit(staged)
    bucketed = model.transform(staged)
    top = 2**bits - 1
    # One more than the last regular bucket is the one for NULL.
    last = [len(splits) - 1 for splits in model.getSplitsArray()]
    spread = [F.floor(F.col(b) * F.lit(top / n)) for b, n in zip(buckets, last)]
    z = interleave(spread, bits)
    return bucketed.withColumn(name, z).drop(*numbers, *buckets)
