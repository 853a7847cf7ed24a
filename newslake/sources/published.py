"""The published table: articles in publishing form, by run; batch jobs and streams share it."""

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake.operators.articles import to_document
from newslake.operators.common import attach
from newslake.operators.dedup import keep_first
from newslake.session import passing, staged
from newslake.sources import runs

ROWS = "content string, id string, published_at bigint, title string, url string, source string"
_MANIFEST = "source string, rows bigint"
_SKETCH = (["source"], "id")
_COLUMNS = ["content", "id", "published_at", "source", "title", "url"]


def _summary(rows: DataFrame) -> DataFrame:
    return rows.groupBy("source").agg(F.count("*").alias("rows"))


def run_name(kind: str, *parts) -> str:
    """A name that is the same for the same work, so that work done twice is there once."""
    return f"{kind}_{hashlib.md5(repr(parts).encode()).hexdigest()}"


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """All rows of finished runs."""
    return runs.read_runs(spark, path, ROWS).select(*_COLUMNS)


def compact(spark: SparkSession, path: str) -> int:
    """Lay young runs out anew in few files by source (``runs.compact``)."""
    with passing(spark):
        return runs.compact(spark, path, ROWS, _MANIFEST, ["source"], _SKETCH)


def published_among(spark: SparkSession, path: str, documents: DataFrame) -> DataFrame:
    """``source, id`` of runs and packs that may hold an id of the documents; others are not opened."""
    keys = staged(documents.select("source", "id").distinct(), "keys")
    catalog = runs.manifest(spark, path, _MANIFEST)
    return runs.read_runs(spark, path, ROWS, parts=runs.parts_holding(spark, path, keys, catalog, *_SKETCH)).select("source", "id")


def insert_new(documents: DataFrame, published: DataFrame, by=("source", "id")) -> DataFrame:
    """The documents whose id the published table does not hold, one of each id.

    The table's ids are first reduced to those of the new rows, a join whose small side is the new rows' key list, so
    the large table is neither shuffled nor compared as a whole.
    """
    wanted = staged(documents.select(*by).distinct(), "wanted")
    known = staged(attach(published.select(*by), wanted, by, "left_semi").distinct(), "known")
    fresh = staged(attach(wanted, known, by, "left_anti"), "fresh")
    first = [c for c in ("published_at", "url") if c in documents.columns]
    if fresh.count() <= known.count():
        # Most are known, so the few others are picked before whole documents are compared.
        return keep_first(attach(documents, fresh, by, "left_semi"), tuple(by[:-1]), by[-1], first)
    return attach(keep_first(documents, tuple(by[:-1]), by[-1], first), known, by, "left_anti")


def publish(articles: DataFrame, path: str, run: str | None = None, mode: str = "append") -> str:
    """Add articles in published form as a run, and return its name.

    A run that is there already is left as it is. ``"append"`` takes all rows, ``"insert_new"`` leaves out ids that
    other runs have and copies among the new rows.
    """
    if mode not in ("append", "insert_new"):
        raise ValueError(f"mode must be 'append' or 'insert_new', not {mode!r}")
    spark, run = articles.sparkSession, run or f"run_{uuid.uuid4().hex}"
    if runs.committed(spark, path, run):
        return run
    documents = to_document(articles)
    if mode == "insert_new":
        documents = insert_new(documents, published_among(spark, path, documents))
    runs.write_run(documents.select(*_COLUMNS), path, run, ["source"], _summary, _SKETCH)
    return run
