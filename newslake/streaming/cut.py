"""The incremental cut of listings whose pages land bit by bit, as a stream.

What a micro-batch takes, and which listings it has ended, is one run of a run table: the state between micro-batches,
and the result. A replay finds its run there. A listing that has met a known article takes nothing more; one that
never does is kept or dropped once the caller says that no more pages come (``ended``).
"""

from concurrent.futures import Future

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake.operators.common import KEYS, ORDER, attach, place
from newslake.operators.cut import stop_places
from newslake.operators.dedup import keep_first
from newslake.operators.ranking import rank_all
from newslake.session import passing, staged
from newslake.sources import runs


def _schema(columns) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in columns) + ", part string"


def run_cut(listing: DataFrame, seen: DataFrame, path: str, checkpoint: str, keys=KEYS, order=ORDER) -> None:
    """Cut the cards that have landed since the last run at the known ids in ``seen(keys, id)``.

    Cards of one listing land newest first: those of a later micro-batch stand below those of earlier ones. Only cards
    above the first known id are stored; a listing is held by no task, as the cut is that of a batch.
    """
    columns, known = listing.dtypes, Future()

    def load(batch: DataFrame, epoch: int) -> None:
        spark, run = batch.sparkSession, f"cut_{known.result(timeout=300)}_{epoch}"
        with passing(spark):
            if runs.committed(spark, path, run):
                return
            stopped = staged(stopped_listings(spark, path, columns, keys), "stopped")
            cards = staged(attach(batch, stopped, keys, "left_anti"), "cards")
            stops = stop_places(cards, attach(seen, stopped, keys, "left_anti"), keys, order)
            above = attach(cards, stops, keys).filter(F.col("_stop").isNull() | (place(order) < F.col("_stop"))).drop("_stop")
            # A listing that ends here leaves a row of its keys alone.
            marks = stops.select(*keys, *(F.lit(None).cast(kind).alias(name) for name, kind in columns if name not in keys))
            rows = keep_first(above, keys, "id", order).withColumn("part", F.lit("card")).unionByName(
                marks.select(*batch.columns).withColumn("part", F.lit("stop")))
            runs.write_run(rows, path, run, ["part"], lambda d: d.groupBy("part").agg(F.count("*").alias("rows")))

    query = listing.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    known.set_result(str(query.id))
    query.awaitTermination()


def stopped_listings(spark: SparkSession, path: str, columns, keys=KEYS) -> DataFrame:
    """The listings that have met a known article."""
    return runs.read_runs(spark, path, _schema(columns)).filter("part = 'stop'").select(*keys).distinct()


def ended(spark: SparkSession, path: str, columns, keys=KEYS, order=ORDER, on_no_match="keep") -> DataFrame:
    """What all micro-batches have taken, with ranks, once no more pages come: as ``take_until_seen`` gives it at once.

    A listing without a known article is kept, or with ``on_no_match="drop"`` yields nothing; a boolean column of the
    cards says for each whether to keep. A card that has landed twice counts where it first stood.
    """
    if isinstance(on_no_match, str) and on_no_match not in ("keep", "drop"):
        raise ValueError(f"on_no_match must be 'keep' or 'drop', not {on_no_match!r}")
    keep = F.lit(on_no_match == "keep") if isinstance(on_no_match, str) else on_no_match
    stopped = stopped_listings(spark, path, columns, keys).withColumn("_stopped", F.lit(True))
    cards = runs.read_runs(spark, path, _schema(columns)).filter("part = 'card'").drop("part", "run")
    taken = attach(cards, stopped, keys).filter(F.col("_stopped").isNotNull() | keep).drop("_stopped")
    return rank_all(keep_first(taken, keys, "id", order), keys, order).drop("total")
