"""Crawl state that lives in batch keys: which file comes last, and which ids it holds."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.schema import RECENT_IDS

# The two key conventions. Objects named by hand follow the first, our sink the second:
#   web_crawler/{site}/[{category}/]{site}[_{category}]_initial_batch_{N}.json
#   web_crawler/{site}/[{category}/]{site}[_{category}]_incremental_crawled_at_{epoch}.json
#   site={site}/category={category}/batch={initial|incremental}_{N}/part-*
_NAMED = r"web_crawler/([^/]+)/(?:([^/]+)/)?([^/]+?)_(initial_batch|incremental_crawled_at)_(\d+)\.json$"
_LAID = r"site=([^/]+)/category=([^/]+)/batch=(initial|incremental)_(\d+)/part-[^/]*$"
_NO_CATEGORY = "__HIVE_DEFAULT_PARTITION__"


def batch_key(site: Column, category: Column, kind: Column, seq: Column) -> Column:
    """The key of a batch in the first convention."""
    stem = F.concat_ws("_", site, category)
    mark = F.when(kind == "initial", "_initial_batch_").otherwise("_incremental_crawled_at_")
    return F.concat(F.concat_ws("/", F.lit("web_crawler"), site, category, stem), mark, seq.cast("string"),
                    F.lit(".json"))


def parse_keys(files: DataFrame, path="path") -> DataFrame:
    """Add ``site, category, kind, seq, stamp``; files that are no batch are dropped.

    The file name must repeat the folder names literally, so a dot in a site name is only a dot. In our own layout
    folder names are escaped as the partition writer does it; they are read back here, once.
    """
    def unescaped(part):
        return F.coalesce(F.try_url_decode(F.replace(part, F.lit("+"), F.lit("%2B"))), part)

    def pick(laid, named):
        own = F.nullif(F.nullif(F.regexp_extract(path, _LAID, laid), F.lit("")), F.lit(_NO_CATEGORY))
        return F.coalesce(unescaped(own),
                          F.nullif(F.regexp_extract(path, _NAMED, named), F.lit("")))

    found = files.withColumns({
        "site": pick(1, 1), "category": pick(2, 2),
        "kind": F.split_part(pick(3, 4), F.lit("_"), F.lit(1)), "stamp": pick(4, 5),
        "_stem": F.nullif(F.regexp_extract(path, _NAMED, 3), F.lit("")),
    })
    expected = F.concat_ws("_", "site", "category")
    return found.filter(F.col("stamp").isNotNull() & (F.col("_stem").isNull() | (F.col("_stem") == expected))) \
        .withColumn("seq", F.col("stamp").cast("bigint")).drop("_stem")


def latest_batch(catalog: DataFrame) -> DataFrame:
    """The initial batch with the highest number, per site and category."""
    return catalog.filter(F.col("kind") == "initial").groupBy("site", "category").agg(
        F.max("seq").alias("last_batch"), F.max_by("path", F.struct("seq", "path")).alias("path"))


def state_file(catalog: DataFrame) -> DataFrame:
    """The file whose first ids mark the newest known articles, per site and category.

    The incremental file with the greatest stamp, compared as text; without one, the initial batch
    with the lowest number.
    """
    newest = F.max_by("path", F.when(F.col("kind") == "incremental", F.struct("stamp", "path")))
    first = F.min_by("path", F.when(F.col("kind") == "initial", F.struct("seq", "path")))
    return catalog.groupBy("site", "category").agg(F.coalesce(newest, first).alias("path"))


def resume_point(batches: DataFrame, by=("path",)) -> DataFrame:
    """The id of the last element of each batch."""
    return batches.groupBy(*by).agg(F.max_by("id", "pos").alias("last_id"))


def recent_ids(batches: DataFrame, n: int = RECENT_IDS) -> DataFrame:
    """The first ``n`` ids of each batch; a shorter batch gives fewer."""
    return batches.filter(F.col("pos") < n)
