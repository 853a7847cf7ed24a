"""The scheduled incremental load as Structured Streaming: run, take what is new, stop."""

from concurrent.futures import Future

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake.schema import ARTICLE_COLUMNS
from newslake.session import passing, staged
from newslake.sources import published, runs
from newslake.sources.articles import WHOLE_BELOW, parse_files, plain_path

_FILES = "path string, problem string, rows bigint"
_LISTED = "path string, modificationTime timestamp, length bigint, content binary"


def landed_batches(spark: SparkSession, path: str, max_files: int = 10_000, whole_below: int = WHOLE_BELOW) -> DataFrame:
    """Landed batch files as a stream of ``path, value, whole``; ``max_files`` bounds one micro-batch.

    Files of ``whole_below`` bytes and more are not ``whole``: they come by name, without a value, and the task that parses
    them reads them in chunks (``split_values``). Files count as new whenever they land, whatever their time stamp says.
    """
    def landed(kind, fits):
        files = (
            spark.readStream.format(kind).option("recursiveFileLookup", True)
            .option("maxFilesPerTrigger", max_files).option("maxFileAge", "36500d")
        )
        files = (files.option("wholetext", True) if fits else files.schema(_LISTED)).load(path)
        size = F.col("_metadata.file_size")
        return files.filter(size < whole_below if fits else size >= whole_below).select(
            plain_path(F.col("_metadata.file_path")).alias("path"), (F.col("value") if fits else F.lit(None).cast("string")).alias("value"),
            F.lit(fits).alias("whole"))

    return landed("text", True).unionByName(landed("binaryFile", False))


def landed_articles(stream: DataFrame) -> DataFrame:
    """The articles of landed files, still as a stream; files with a problem give none."""
    return parse_files(stream).select(F.explode("rows").alias("row")).select("row.*")


def ingested_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, problem, rows`` of all files taken so far; a problem says why a file gave no rows."""
    return runs.read_runs(spark, f"{path}/files", _FILES).select("path", "problem", "rows")


def rejected_files(spark: SparkSession, path: str) -> DataFrame:
    return ingested_files(spark, path).filter(F.col("problem").isNotNull()).select("path", "problem")


def run_ingest(stream: DataFrame, path: str, checkpoint: str, dedup: bool = False) -> None:
    """Take every file that landed since the last run into the published table at ``path``.

    A micro-batch is a run of its own, named after the query's id, which lives in the checkpoint, and its number; a
    replay after a failure finds it there. A list of the files taken stands beside the table, so a new checkpoint,
    which sees all files again, takes only those that no run has taken. A file that holds no articles goes to
    ``rejected_files`` and stops nothing. With ``dedup`` an id enters once, whether its copies are in one file or
    several, or came by another job.
    """
    known = Future()

    def load(batch: DataFrame, epoch: int) -> None:
        spark, run = batch.sparkSession, f"stream_{known.result(timeout=300)}_{epoch}"
        with passing(spark):
            taken = staged(ingested_files(spark, path).select("path"), "taken") if not runs.committed(
                spark, f"{path}/files", run) else None
            if taken is None:
                return
            # Names are compared first; whole texts only where some of the files are known and others not.
            here = staged(batch.select("path", F.lit(True).alias("here")).join(taken.withColumn("old", F.lit(True)), "path", "left"), "here")
            old, new = (not here.filter(which).isEmpty() for which in ("old", "old IS NULL"))
            if not new:
                return
            files = parse_files(batch.join(taken, "path", "left_anti") if old else batch)
            landed = staged(files.select("path", "problem", F.explode_outer("rows").alias("row")), "landed")
            # A file with a problem gives no rows, wherever in it the problem is.
            broken = staged(landed.filter(F.col("problem").isNotNull()).select("path").distinct(), "broken")
            rows = landed.filter(F.col("row").isNotNull()).join(broken, "path", "left_anti").select("row.*")
            published.publish(rows.select(*ARTICLE_COLUMNS), path, run, "insert_new" if dedup else "append")
            # The files count as taken once their rows are published; in between, a replay finds the run there.
            taken_now = landed.groupBy("path").agg(F.max("problem").alias("problem"), F.count("row").alias("n"))
            done = taken_now.select(
                F.lit("file").alias("part"), "path", "problem", F.when(F.col("problem").isNull(), F.col("n")).alias("rows"))
            runs.write_run(done, f"{path}/files", run, ["part"], lambda d: d.groupBy("part").count())

    query = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    known.set_result(str(query.id))
    query.awaitTermination()


def published_table(spark: SparkSession, path: str) -> DataFrame:
    return published.read_published(spark, path)


def dedup_within(stream: DataFrame, delay: str = "7 days") -> DataFrame:
    """Stateful form: one row per id among rows that arrive within ``delay`` of each other.

    The watermark is on arrival time, since a publish date may be missing or years old; state for an
    id is dropped after the delay, so it does not grow with the table.
    """
    arrived = stream.withColumn("arrived_at", F.current_timestamp()).withWatermark("arrived_at", delay)
    return arrived.dropDuplicatesWithinWatermark(["source", "id"]).drop("arrived_at")


def run_ingest_by_state(stream: DataFrame, path: str, checkpoint: str, delay: str = "7 days") -> None:
    """As ``run_ingest`` with ``dedup``, by keyed state: an id that came within ``delay`` is known to the stream itself.

    Copies end at the state, which Spark keeps in the checkpoint and drops after the delay, so it does not grow with the
    table. What passes is looked up in the table, since state may have expired, be of another checkpoint, or the id may
    have come by another job; the runs' sketches say which parts of the table may hold such an id, and no others are
    opened. A file that holds no articles enters ``rejected_files`` once.
    """
    parsed = parse_files(stream).select("path", "problem", F.explode_outer("rows").alias("row")).select("path", "problem", "row.*")
    bad = F.col("problem").isNotNull()
    # A broken file is a row of its own kind under its path.
    rows = parsed.filter(bad | F.col("id").isNotNull() | F.col("url").isNotNull()).withColumns({
        "id": F.when(bad, F.col("path")).otherwise(F.col("id")), "source": F.when(bad, F.lit("")).otherwise(F.col("source"))})
    known = Future()

    def load(batch: DataFrame, epoch: int) -> None:
        spark, run = batch.sparkSession, f"state_{known.result(timeout=300)}_{epoch}"
        with passing(spark):
            if runs.committed(spark, f"{path}/files", run):
                return
            came = staged(batch, "came")
            published.publish(came.filter("problem IS NULL").select(*ARTICLE_COLUMNS), path, run, "insert_new")
            broken = came.filter("problem IS NOT NULL").select(
                F.lit("file").alias("part"), "path", "problem", F.lit(None).cast("bigint").alias("rows"))
            runs.write_run(broken, f"{path}/files", run, ["part"], lambda d: d.groupBy("part").count())

    query = dedup_within(rows, delay).writeStream.foreachBatch(load).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start()
    known.set_result(str(query.id))
    query.awaitTermination()
