"""Export: JSON lines, and one JSON array per batch for readers that want files."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.schema import ARTICLE_COLUMNS


def write_articles(articles: DataFrame, path: str) -> None:
    """Append as JSON lines."""
    articles.select(*ARTICLE_COLUMNS).write.mode("append").json(path)


def write_batches(rows: DataFrame, path: str, kind: str = "initial") -> None:
    """One JSON array per (site, category, batch_no), in listing order; no rows, no file.

    An export: the lake itself is a table (``sources.lake``), since a folder and a file for each hundred rows cost
    their listing and renaming ever after.
    A group is one batch, so it holds at most the batch size or the run limit of rows. Writing a
    batch again replaces it, and leaves the others.
    """
    article = F.struct(*ARTICLE_COLUMNS)
    label = F.concat(F.lit(f"{kind}_"), F.col("batch_no"))
    batches = rows.groupBy("site", "category", label.alias("batch")).agg(
        F.sort_array(F.collect_list(F.struct("rn", article.alias("article")))).alias("rows"))
    texts = batches.select(
        "site", "category", "batch",
        F.to_json(F.transform("rows", lambda r: r["article"]), {"ignoreNullFields": "false", "pretty": "true"})
        .alias("value"))
    # A batch is one row, so each folder gets one file with one array.
    texts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("site", "category", "batch").text(path)
