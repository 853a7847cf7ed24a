"""The article lake: batches as rows of a run table, crawl state as pruned scans of it."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake.operators.common import attach
from newslake.schema import ARTICLE_COLUMNS
from newslake.session import passing
from newslake.sources import runs
from newslake.sources.runs import committed  # noqa: F401

ROWS = ", ".join(f"{c} string" for c in ARTICLE_COLUMNS) + ", kind string, seq bigint, pos bigint, site string, category string"
MANIFEST = "site string, category string, kind string, first_seq bigint, last_seq bigint, rows bigint"
_SITE = ["site", "category"]
_SKETCH = (_SITE, "id")


def _summary(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*_SITE, "kind").agg(
        F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"), F.count("*").alias("rows"))


def write_batch_rows(rows: DataFrame, root: str, run: str, kind: str) -> None:
    """``rows(site, category, batch_no, pos, article columns)`` as a run; ``pos`` is a row's place in its batch."""
    runs.write_run(rows.select(*ARTICLE_COLUMNS, F.lit(kind).alias("kind"), F.col("batch_no").cast("bigint").alias("seq"),
                               F.col("pos").cast("bigint").alias("pos"), *_SITE), root, run, _SITE, _summary, _SKETCH)


def compact(spark: SparkSession, root: str) -> int:
    """Lay young runs out anew in few files by site and category (``runs.compact``)."""
    with passing(spark):
        return runs.compact(spark, root, ROWS, MANIFEST, _SITE, _SKETCH)


def batch_manifest(spark: SparkSession, root: str) -> DataFrame:
    """What is stored: a row for each run, site, category and kind, with the part that holds it."""
    return runs.manifest(spark, root, MANIFEST)


def batch_rows(spark: SparkSession, root: str, chosen: DataFrame | None = None) -> DataFrame:
    """The rows of committed runs, or of chosen ones."""
    return runs.read_runs(spark, root, ROWS, chosen)


def latest_batches(catalog: DataFrame) -> DataFrame:
    """The highest number of an initial batch, per site and category."""
    return catalog.filter(F.col("kind") == "initial").groupBy(*_SITE).agg(
        F.max("last_seq").alias("last_batch"), F.max_by("run", "last_seq").alias("run"))


def state_batches(catalog: DataFrame) -> DataFrame:
    """The batch with the newest known articles per site and category: the last incremental one, else the first
    initial one."""
    newest = F.max(F.when(F.col("kind") == "incremental", F.struct("last_seq", "run", "kind")))
    first = F.min(F.when(F.col("kind") == "initial", F.struct("first_seq", "run", "kind")))
    return catalog.groupBy(*_SITE).agg(
        F.coalesce(newest["last_seq"], first["first_seq"]).alias("seq"), F.coalesce(newest["run"], first["run"]).alias("run"),
        F.coalesce(newest["kind"], first["kind"]).alias("kind"))


def _before(catalog: DataFrame, stamp: int | None) -> DataFrame:
    return catalog if stamp is None else catalog.filter((F.col("kind") != "incremental") | (F.col("last_seq") < stamp))


def _rows_of(spark, root, batches: DataFrame) -> DataFrame:
    """The rows of the named batches; the reader is told runs, so other folders are not opened."""
    rows = batch_rows(spark, root, batches)
    return attach(rows, batches, [*_SITE, "run", "kind", "seq"], "left_semi")


def known_ids(spark: SparkSession, root: str, before: int | None = None, recent: int | None = None) -> DataFrame:
    """``site, category, id`` of stored articles: all of them, or the first ``recent`` of the state batch.

    ``before`` leaves out incremental runs of that stamp and later, so a run that is repeated never takes its own
    rows for known.
    """
    catalog = _before(batch_manifest(spark, root), before)
    if recent is None:
        return batch_rows(spark, root, catalog).select(*_SITE, "id")
    return _rows_of(spark, root, state_batches(catalog)).filter(F.col("pos") < recent).select(*_SITE, "id")


def begun(spark: SparkSession, root: str, before: int | None = None) -> DataFrame:
    """The sites and categories that have a stored article, from the manifest alone."""
    return _before(batch_manifest(spark, root), before).filter("rows > 0").select(*_SITE).distinct()


def known_among(spark: SparkSession, root: str, shown: DataFrame, before: int | None = None) -> DataFrame:
    """Which of the ``shown(site, category, id)`` are stored: as ``known_ids`` would say, but only runs and packs whose
    sketch may hold one of them are opened, and looked through for certain."""
    catalog = _before(batch_manifest(spark, root), before)
    parts = runs.parts_holding(spark, root, shown, catalog, *_SKETCH)
    stored = runs.read_runs(spark, root, ROWS, None if before is None else catalog, parts)
    return attach(stored.select(*_SITE, "id"), shown, [*_SITE, "id"], "left_semi")


def resume_points(spark: SparkSession, root: str) -> DataFrame:
    """``site, category, last_id, last_batch`` of the last initial batch."""
    last = latest_batches(batch_manifest(spark, root)).withColumns({"seq": F.col("last_batch"), "kind": F.lit("initial")})
    return _rows_of(spark, root, last).groupBy(*_SITE).agg(
        F.max_by("id", "pos").alias("last_id"), F.max("seq").alias("last_batch"))
