"""Where a run starts and stops in a listing that is ordered newest first."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from newslake.operators.common import KEYS, ORDER, attach, place
from newslake.operators.dedup import keep_first
from newslake.operators.ranking import rank_all, top_n
from newslake.session import staged


def _markers(rejects):
    """Rejected cards that were looked at; links on a skip list never are."""
    named = rejects.filter(F.col("id").isNotNull())
    return named.filter(F.col("reject_reason") != "skipped link") if "reject_reason" in rejects.columns else named


def _places(listing, rejects, keys, order):
    """Ids and places of all cards; one that is rejected for its title or date still marks its place."""
    columns = [*keys, "id", *order]
    cards = listing.select(*columns)
    return cards if rejects is None else cards.unionByName(_markers(rejects).select(*columns))


def stop_places(listing: DataFrame, seen: DataFrame, keys=KEYS, order=ORDER, rejects=None) -> DataFrame:
    """The first place per key whose id is already known, as a stored table (one row per key)."""
    known = staged(seen.select(*keys, "id").distinct(), "seen")
    hits = attach(_places(listing, rejects, keys, order), known, [*keys, "id"], "left_semi")
    return staged(hits.groupBy(*keys).agg(F.min(place(order)).alias("_stop")), "stops")


def take_until_seen(listing: DataFrame, seen: DataFrame, max_news: int | None = None, on_no_match="keep",
                    keys=KEYS, order=ORDER, rejects=None) -> DataFrame:
    """Incremental cut: distinct rows above the first known id, with their rank; no more than ``max_news`` per key if
    that is given.

    A prefix, not an anti-join: an unknown row below the first known one is not taken. A key whose
    listing ends before a known id or the limit is met is kept, or with ``on_no_match="drop"``
    yields nothing; a boolean column says for each row of the listing whether to keep. ``rejects`` are cards that
    cannot be taken but end the run if they are known.

    Two scans of the listing, both joined with tables of one row per key; only the rows above the
    stop are shuffled.
    """
    if isinstance(on_no_match, str) and on_no_match not in ("keep", "drop"):
        raise ValueError(f"on_no_match must be 'keep' or 'drop', not {on_no_match!r}")
    keep = F.lit(on_no_match == "keep") if isinstance(on_no_match, str) else on_no_match
    stops = stop_places(listing, seen, keys, order, rejects)
    above = attach(listing.withColumn("_keep", keep), stops, keys) \
        .filter(F.col("_stop").isNull() | (place(order) < F.col("_stop")))
    if max_news is None:
        ended = above.filter(F.col("_stop").isNotNull() | F.col("_keep")).drop("_stop", "_keep")
        return rank_all(keep_first(ended, keys, "id", order), keys, order).drop("total")
    if isinstance(on_no_match, str) and on_no_match == "keep":
        return top_n(keep_first(above.drop("_stop", "_keep"), keys, "id", order), max_news, keys, order)
    # One row beyond the limit shows that the limit was met; a key has max_news + 1 rows at most here.
    marked = above.withColumn("_met", F.col("_stop").isNotNull() | F.col("_keep")).drop("_stop", "_keep")
    best = top_n(keep_first(marked, keys, "id", order), max_news + 1, keys, order)
    in_key = W.partitionBy(*keys)
    ended = F.col("_met") | (F.max("rn").over(in_key) > max_news)
    if rejects is not None:
        # With the limit just reached, a further card shows it too, even one that cannot be taken.
        best = staged(best, "best")
        others = attach(_markers(rejects).select(*keys, "id", *order), best.select(*keys, "id"), [*keys, "id"], "left_anti")
        best = attach(best, others.groupBy(*keys).agg(F.max(place(order)).alias("_last")), keys)
        full = F.max("rn").over(in_key) == max_news
        ended = ended | (full & F.coalesce(F.col("_last") > F.max(place(order)).over(in_key), F.lit(False)))
    return best.withColumn("_ended", ended).filter(F.col("_ended") & (F.col("rn") <= max_news)) \
        .drop("_met", "_ended", "_last")


def resume_after(listing: DataFrame, last_ids: DataFrame, keys=KEYS, order=ORDER, rejects=None) -> DataFrame:
    """Restart of a full run: distinct rows below the row with the last stored id.

    ``last_ids(keys..., last_id)``; a key without a row there is taken whole, and one whose last id
    does not occur yields nothing. The last id may be that of a card among the ``rejects``.
    """
    state = staged(last_ids.select(*keys, "last_id"), "last_ids")
    probe = state.withColumnRenamed("last_id", "id")
    met = attach(_places(listing, rejects, keys, order), probe, [*keys, "id"], "left_semi") \
        .groupBy(*keys).agg(F.min(place(order)).alias("_cut"))
    cuts = staged(attach(state, met, keys).withColumn("_state", F.lit(True)), "cuts")
    below = attach(listing, cuts, keys).filter(
        F.col("_state").isNull() | ((place(order) > F.col("_cut")) & (F.col("id") != F.col("last_id"))))
    return keep_first(below.drop("_state", "_cut", "last_id"), keys, "id", order)
