"""Row operators on articles: projection, filters, defaults, publishing form, rejects, reports."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.functions import dates, text
from newslake.schema import ARTICLE_COLUMNS, NO_CONTENT, NO_DATE, NO_TITLE


def to_article(rows: DataFrame, source: Column | None = None) -> DataFrame:
    """The six article columns; the id comes from the URL unless there is one, absent columns are NULL."""
    have = set(rows.columns)
    values = {c: F.col(c) if c in have else F.lit(None) for c in ARTICLE_COLUMNS}
    if "id" not in have:
        values["id"] = text.url_id(F.col("url"))
    if source is not None:
        values["source"] = source
    return rows.select(*[values[c].cast("string").alias(c) for c in ARTICLE_COLUMNS])


def filter_links(cards: DataFrame, blacklist=("/about", ""), href="href", title="title") -> DataFrame:
    """Cards with a usable link and a title."""
    return cards.filter(~F.col(href).isin(list(blacklist)) & F.col(title).isNotNull())


def fill_defaults(articles: DataFrame, blank_is_missing: bool = True) -> DataFrame:
    """Fixed texts for what is missing."""
    defaults = {"content": NO_CONTENT, "title": NO_TITLE, "published_at": NO_DATE}
    return articles.withColumns({
        name: text.or_default(F.col(name), value, blank_is_missing)
        for name, value in defaults.items() if name in articles.columns
    })


def split_rejects(rows: DataFrame, **required: Column):
    """Rows that meet all named conditions, and the others with the first unmet name as reason."""
    reason = F.lit(None).cast("string")
    for name, condition in reversed(required.items()):
        reason = F.when(~F.coalesce(condition, F.lit(False)), F.lit(name)).otherwise(reason)
    marked = rows.withColumn("reject_reason", reason)
    return marked.filter(F.col("reject_reason").isNull()).drop("reject_reason"), \
        marked.filter(F.col("reject_reason").isNotNull())


def to_document(articles: DataFrame) -> DataFrame:
    """The published form: ``published_at`` in epoch seconds, NULL where unknown."""
    return articles.withColumn("published_at", dates.finalize_published_at(F.col("published_at")))


def listing_with_detail(listing: DataFrame, detail: DataFrame, on="url", order=("page_id",)) -> DataFrame:
    """Each listing row with the detail of its page; the detail's values come first, the listing's
    id and source stay.

    Copies of a page are merged before the join, so the detail side has one row per URL and a hot
    URL on the listing side is left to the adaptive skew join.
    """
    values = [c for c in detail.columns if c not in (on, "id", "source", *order)]
    one = detail.groupBy(on).agg(F.min(F.struct(*order, *values)).alias("d"))
    both = [c for c in values if c in listing.columns]
    out = [F.coalesce(F.col(f"d.{c}"), F.col(c)).alias(c) if c in both else F.col(c) for c in listing.columns]
    return listing.join(one, on, "left").select(
        *out, *[F.col(f"d.{c}").alias(c) for c in values if c not in both])


def quality_flags(articles: DataFrame, *keep: str) -> DataFrame:
    """Which fields still hold a default. Narrow, so texts need not travel to the report."""
    return articles.select(
        *keep,
        (F.col("content") == NO_CONTENT).alias("no_content"),
        (F.col("title") == NO_TITLE).alias("no_title"),
        (F.col("published_at") == NO_DATE).alias("no_date"),
    )


def quality_report(flags: DataFrame, by=("source",)) -> DataFrame:
    """Per source: rows, and how many have no content, no title, no date."""
    return flags.groupBy(*by).agg(
        F.count("*").alias("articles"),
        *[F.count_if(name).alias(name) for name in ("no_content", "no_title", "no_date")],
    )


def cards_per_page(cards: DataFrame) -> DataFrame:
    return cards.groupBy("page_id").agg(F.count("*").alias("cards"))
