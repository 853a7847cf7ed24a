"""De-duplication. Both forms combine copies before the shuffle, so a hot id costs a row per task."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.operators.common import KEYS, ORDER


def dedup_any(articles: DataFrame, by=("id",)) -> DataFrame:
    """One row per id, any of its copies; rows without id count as copies of one another."""
    return articles.dropDuplicates(list(by))


def keep_first(listing: DataFrame, keys=KEYS, id_column="id", order=ORDER) -> DataFrame:
    """One row per id within ``keys``: the earliest in listing order, ties by the other columns.

    The minimum of a row is an ordinary aggregate with a map-side part; a window with
    ``row_number`` would ship every copy of an id to one task.
    """
    group = [*keys, id_column]
    rest = [c for c in listing.columns if c not in group and c not in order]
    least = F.min(F.struct(*order, *rest)).alias("row")
    return listing.groupBy(*group).agg(least).select(
        *[F.col(c) if c in group else F.col(f"row.{c}") for c in listing.columns])
