"""Comparing two copies of a table by digests of key ranges.

The range of a numeric or temporal key is cut into coarse ranges and each of these into fine ones. A
tree holds, per range, the number of rows and the sum of their 128-bit digests, in which neither
order nor partitioning plays a part. Two copies compare the coarse digests, then the
fine ones below those that differ, and read rows only in fine ranges that differ, by a
filter on the key that the scan can use. Keys of other types are cut by hash, which
limits the rows that are compared but not those that are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ByteType, DateType, IntegerType, LongType, ShortType, TimestampNTZType, TimestampType

COARSE = 64
FINE = 64
SPANS = 100
JSON = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def row_digest(*columns: str) -> Column:
    """MD5 of a row's values, names and NULLs included."""
    return F.md5(F.to_json(F.struct(*columns), JSON))


def digest_sums(digest: Column) -> list[Column]:
    """Sums of both 64-bit halves of hexadecimal digests; no order, no overflow."""
    half = lambda at: F.conv(F.substring(digest, at, 16), 16, 10).cast("decimal(28,0)")
    return [F.sum(half(1)).alias("high"), F.sum(half(17)).alias("low")]


def ordinal(df: DataFrame, key: str) -> Column | None:
    """The key as an integer of the same order, or None for other types."""
    kind = df.schema[key].dataType
    if isinstance(kind, (ByteType, ShortType, IntegerType, LongType)):
        return F.col(key).cast("bigint")
    if isinstance(kind, DateType):
        return F.unix_date(key).cast("bigint")
    if isinstance(kind, TimestampType):
        return F.unix_micros(key)
    if isinstance(kind, TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(key))
    return None


class Ranges:
    """The cut of a key: numbers of fine ranges, and the filter for some of them. NULL keys are range -1."""

    def __init__(self, a: DataFrame, b: DataFrame, key: str, *, coarse: int = COARSE, fine: int = FINE):
        self.key, self.fine, self.number = key, fine, ordinal(a, key)
        self.count = coarse * fine
        if self.number is not None:
            ends = [d.agg(F.min(self.number).alias("lo"), F.max(self.number).alias("hi")).first() for d in (a, b)]
            lo, hi = [x.lo for x in ends if x.lo is not None], [x.hi for x in ends if x.hi is not None]
            self.lo = min(lo, default=0)
            self.width = -(-(max(hi, default=0) - self.lo + 1) // self.count)

    def range_of(self) -> Column:
        if self.number is None:
            at = F.pmod(F.xxhash64(self.key), F.lit(self.count))
        else:  # whole division of numbers that may be large
            at = F.expr(f"({{}} - {self.lo}L) DIV {self.width}L".format("_ordinal"))
        return F.when(F.col(self.key).isNull(), F.lit(-1)).otherwise(at).cast("bigint")

    def tree(self, df: DataFrame) -> DataFrame:
        """(range, n, high, low) per fine range, one scan; coarse digests are sums of these."""
        d = df.withColumn("_digest", row_digest(*df.columns))
        if self.number is not None:
            d = d.withColumn("_ordinal", self.number)
        return d.groupBy(self.range_of().alias("range")).agg(F.count("*").alias("n"), *digest_sums(F.col("_digest")))

    def rows(self, df: DataFrame, differing: list[int]) -> DataFrame:
        """The rows of some fine ranges; neighbours are one interval of the key."""
        if not differing:
            return df.where(F.lit(False))
        test = F.col(self.key).isNull() if -1 in differing else F.lit(False)
        if self.number is None:
            return df.where(test | F.pmod(F.xxhash64(self.key), F.lit(self.count)).isin([x for x in differing if x >= 0]))
        spans: list[list[int]] = []
        for x in sorted(x for x in differing if x >= 0):
            if spans and spans[-1][1] + 1 == x:
                spans[-1][1] = x
            else:
                spans.append([x, x])
        between = lambda first, last: self.number.between(self.lo + first * self.width, self.lo + (last + 1) * self.width - 1)
        if len(spans) > SPANS:  # differences all over: one interval for the scan, the set of ranges for the rows
            d = df.withColumn("_ordinal", self.number).withColumn("_range", self.range_of())
            return d.where((test | between(spans[0][0], spans[-1][1])) & F.col("_range").isin(differing)).select(df.columns)
        for first, last in spans:
            test = test | between(first, last)
        return df.where(test)


def differing_ranges(a: DataFrame, b: DataFrame, fine: int) -> list[int]:
    """Fine ranges whose digests differ, found below the coarse ones that differ. At most all ranges come to the driver."""
    same = ["n", "high", "low"]

    def differ(x: DataFrame, y: DataFrame) -> DataFrame:
        y = y.select("range", *[F.col(c).alias("_" + c) for c in same])
        equal = F.lit(True)
        for c in same:
            equal = equal & F.col(c).eqNullSafe(F.col("_" + c))
        return x.join(y, "range", "full").where(~equal).select("range")

    up = lambda d: d.groupBy(F.floor(F.col("range") / fine).alias("range")).agg(*[F.sum(c).alias(c) for c in same])
    coarse = differ(up(a), up(b)).select(F.col("range").alias("_coarse"))
    below = lambda d: d.join(coarse, F.floor(F.col("range") / fine) == F.col("_coarse"), "left_semi")
    return [r.range for r in differ(below(a), below(b)).collect()]


def replica_diff(a: DataFrame, b: DataFrame, *, key: str, coarse: int = COARSE, fine: int = FINE) -> DataFrame:
    """Rows on one side only, duplicates counted, with the side they are on; ranges that agree are not read again."""
    cut = Ranges(a, b, key, coarse=coarse, fine=fine)
    differing = differing_ranges(cut.tree(a), cut.tree(b), fine)
    x, y = cut.rows(a, differing), cut.rows(b, differing)
    return x.exceptAll(y).withColumn("side", F.lit("a")).unionByName(y.exceptAll(x).withColumn("side", F.lit("b")))


def snapshot_fingerprint(df: DataFrame, *, key: str, time: str) -> DataFrame:
    """Rows, extremes and an order-free content hash of the keys, all 128 bits of it."""
    high, low = digest_sums(F.md5(F.col(key).cast("string")))
    return df.agg(F.count("*").alias("nrows"), high, low, F.min(time).alias("min_time"), F.max(time).alias("max_time")).select(
        "nrows", F.concat_ws(":", F.col("high").cast("string"), F.col("low").cast("string")).alias("content_hash"), "min_time", "max_time")
