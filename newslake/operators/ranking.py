"""Ranks within a source that hold when one source has a third of all rows."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from newslake.operators.common import KEYS, ORDER, attach
from newslake.session import staged

SALTS = 64


def top_n(listing: DataFrame, n: int, keys=KEYS, order=ORDER, rank="rn", salts: int = SALTS) -> DataFrame:
    """The first ``n`` rows per key in listing order, with their rank.

    The best of each salted part, then the best of those: the last step sorts at most
    ``n * salts`` rows per key. Both windows get a group limit below their shuffle.
    """
    part = F.pmod(F.xxhash64(*order), F.lit(salts))
    inner = W.partitionBy(*keys, "_salt").orderBy(*order)
    outer = W.partitionBy(*keys).orderBy(*order)
    return (
        listing.withColumn("_salt", part)
        .withColumn("_in_part", F.row_number().over(inner)).filter(F.col("_in_part") <= n)
        .withColumn(rank, F.row_number().over(outer)).filter(F.col(rank) <= n)
        .drop("_salt", "_in_part")
    )


def rank_all(listing: DataFrame, keys=KEYS, order=ORDER, rank="rn", total="total") -> DataFrame:
    """Every row's rank within its key, and the key's row count, without a task per key.

    Rows are laid out by range over (key, order), so a large key spreads over many partitions. The
    layout is written once; each partition's share of a key is counted from two narrow columns, and
    running sums over those few counts shift the local row numbers. The counts hold one row per key
    and partition, so their table is small; the optimizer sees its size when it picks the join.
    """
    laid = (
        listing.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
        .withColumn("_row", F.monotonically_increasing_id())
    )
    rows = staged(laid, "ranked").withColumn("_part", F.shiftright("_row", 33))
    runs = rows.groupBy(*keys, "_part").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    in_key = W.partitionBy(*keys)
    before = F.sum("_n").over(in_key.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    shifts = staged(runs.select(
        *keys, "_part",
        (F.coalesce(before, F.lit(0)) - F.col("_first") + 1).alias("_shift"),
        F.sum("_n").over(in_key).alias(total),
    ), "shifts")
    return (
        attach(rows, shifts, [*keys, "_part"], "inner")
        .withColumn(rank, F.col("_row") + F.col("_shift"))
        .drop("_row", "_part", "_shift")
    )


def assign_batches(listing: DataFrame, size=100, base: DataFrame | None = None, keys=KEYS, order=ORDER,
                   remainder="count") -> DataFrame:
    """Number the batches of a full run: label = previous label + rows up to the batch's end.

    ``size`` is a number or a column. ``base(keys..., last_batch)`` holds the previous labels; a key
    without one starts at 0. The last, partial batch adds its row count, or with
    ``remainder="full"``, or where a boolean column says so, a whole batch size.
    """
    if isinstance(remainder, str) and remainder not in ("count", "full"):
        raise ValueError(f"remainder must be 'count' or 'full', not {remainder!r}")
    whole = F.lit(remainder == "full") if isinstance(remainder, str) else remainder
    size = F.lit(size) if isinstance(size, int) else size
    ranked = rank_all(listing, keys, order)
    if base is not None:
        ranked = attach(ranked, base.select(*keys, F.col("last_batch").alias("_base")), keys)
    start = F.coalesce("_base", F.lit(0)) if base is not None else F.lit(0)
    end = F.ceil(F.col("rn") / size).cast("bigint") * size
    end = F.when(whole, end).otherwise(F.least(end, F.col("total")))
    return ranked.withColumn("batch_no", (start + end).cast("bigint")).drop("total", "_base")
