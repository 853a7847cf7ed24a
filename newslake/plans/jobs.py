"""The jobs a user calls. Each is one plan over all sources; a scheduler outside starts them."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake.operators import state
from newslake.operators.articles import fill_defaults, listing_with_detail, to_document
from newslake.operators.common import KEYS, ORDER, attach
from newslake.operators.cut import resume_after, take_until_seen
from newslake.operators.dedup import dedup_any, keep_first
from newslake.operators.ranking import assign_batches
from newslake.schema import ARTICLE_COLUMNS, BATCH_SIZE, NO_CONTENT
from newslake.session import exists, passing, scratch_path, staged
from newslake.sources import lake
from newslake.sources.articles import (
    articles_from_hits, list_batches, read_articles, read_batches_ordered, read_files,
)
from newslake.sources.extract import extract_articles, listing_cards, page_rejects
from newslake.sources.globs import read_inputs
from newslake.sources.published import publish, run_name
from newslake.sources.rules import RULES
from newslake.sources.runs import committed
from newslake.sources.sinks import write_articles

SITE = ("site", "category")


def concat_inputs(spark: SparkSession, inputs, dedup: str = "per_input", layout: str = "array") -> DataFrame:
    """All inputs in one table, by one scan. Copies of an id stay if they come from different inputs
    (``"per_input"``), or not (``"global"``)."""
    if dedup == "global":
        return dedup_any(read_articles(spark, list(inputs), layout))
    if dedup != "per_input":
        raise ValueError(f"dedup must be 'per_input' or 'global', not {dedup!r}")
    return dedup_any(read_inputs(spark, inputs, layout), ("_input", "id")).drop("_input")


def concat(spark: SparkSession, inputs, output: str, dedup: str = "per_input", layout: str = "array") -> None:
    """Union the batches of all inputs, drop copies, append to ``output`` as JSON lines."""
    write_articles(concat_inputs(spark, inputs, dedup, layout), output)


def migrate_rows(spark: SparkSession, root, mode: str = "FAILFAST") -> DataFrame:
    """Every article of every ``.json`` file below ``root`` in published form, with its file."""
    rows, _ = read_batches_ordered(spark, root, mode)
    return to_document(rows.select("path", *ARTICLE_COLUMNS))


def migrate_counts(spark: SparkSession, root) -> DataFrame:
    """``path, inserted, problem``: the rows of each file, or why it has none, and under a NULL path the total.

    Of each article only the id is parsed.
    """
    rows, rejects = read_files(spark, root, "id string")
    counted = rows.groupBy("path").agg(F.count("*").alias("n"))
    return rejects.select("path", F.lit(0).cast("bigint").alias("inserted"), "problem").unionByName(
        counted.rollup("path").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("inserted")).withColumn("problem", F.lit(None).cast("string")))


def migrate_all(spark: SparkSession, root, output: str, mode: str = "FAILFAST", run: str | None = None,
                fmt: str | None = None) -> DataFrame:
    """Publish all batches below ``root`` as one run; returns the files left out, with their problem.

    The run is named after the root unless it is told, so a migration that is started again, or stopped and started, counts
    once. With ``fmt`` the rows are appended to a store of that format instead, which a second start doubles. By default a
    file that holds no articles fails the job before anything is written; with ``mode="PERMISSIVE"`` it is among those
    returned, and the others are written. Files are parsed once.
    """
    if mode not in ("FAILFAST", "PERMISSIVE"):
        raise ValueError(f"mode must be 'FAILFAST' or 'PERMISSIVE', not {mode!r}")
    run = run or run_name("migrate", root)
    left = f"{output}/rejects/run={run}" if fmt is None else scratch_path(spark, "rejects")
    if fmt is not None or not committed(spark, output, run):
        with passing(spark):
            rows, rejects = read_files(spark, root)
            first = rejects.first() if mode == "FAILFAST" else None
            if first is not None:
                raise ValueError(f"{first.path}: {first.problem}")
            rejects.write.mode("overwrite").parquet(left)
            if fmt is None:
                publish(rows.select(*ARTICLE_COLUMNS), output, run)
            else:
                to_document(rows.select(*ARTICLE_COLUMNS)).write.mode("append").format(fmt).save(output)
    return spark.read.schema("path string, problem string").parquet(left)


def _articles(rows: DataFrame, details: DataFrame, extra) -> DataFrame:
    """Rows with details and defaults; a field that neither side has counts as missing."""
    joined = listing_with_detail(rows, details)
    absent = {c: F.lit(None).cast("string") for c in ARTICLE_COLUMNS if c not in joined.columns}
    extra = [c for c in extra if c not in ARTICLE_COLUMNS]
    return fill_defaults(joined.withColumns(absent)).select(*extra, *ARTICLE_COLUMNS)


def incremental(listing: DataFrame, details: DataFrame, seen: DataFrame, max_news: int | None = None,
                on_no_match: str = "keep", keys=KEYS, order=ORDER) -> DataFrame:
    """New articles of all sources: cut the listing, attach details, fill defaults, publishing form.

    The cut comes first and is stored: its links reduce the wide detail side before that is shuffled.
    """
    fresh = staged(take_until_seen(listing, seen, max_news, on_no_match, keys, order), "fresh")
    wanted = details.join(fresh.select("url"), "url", "left_semi")
    return to_document(_articles(fresh, wanted, (*keys, "rn")))


def incremental_from_pages(listing: DataFrame, pages: DataFrame, seen: DataFrame, rules=None,
                           max_news: int | None = None, on_no_match: str = "keep", keys=KEYS,
                           order=ORDER) -> DataFrame:
    """As ``incremental`` with raw ``pages(page_id, url, html, source)``; only new pages are parsed."""
    fresh = staged(take_until_seen(listing, seen, max_news, on_no_match, keys, order), "fresh")
    wanted = pages.join(fresh.select("url"), "url", "left_semi")
    return to_document(_articles(fresh, extract_articles(wanted, rules), (*keys, "rn")))


def full(listing: DataFrame, details: DataFrame, last_ids: DataFrame | None = None,
         base: DataFrame | None = None, batch_size=BATCH_SIZE, keys=KEYS, order=ORDER) -> DataFrame:
    """All articles below the resume point, with batch numbers; not in publishing form.

    Without ``last_ids`` it is a first run, which takes the whole listing. Batches are numbered on
    the narrow listing, and the details join afterwards.
    """
    rest = keep_first(listing, keys, "id", order) if last_ids is None \
        else resume_after(listing, last_ids, keys, order)
    numbered = assign_batches(rest, batch_size, base, keys, order)
    return _articles(numbered, details, (*keys, "batch_no", "rn"))


# ---- state of a folder of JSON batches, as other programs write them

def _picked_rows(spark: SparkSession, root, chosen: DataFrame) -> DataFrame:
    """Ordered articles of the chosen files, one per site and category; others are not read."""
    paths = [row.path for row in chosen.select("path").collect()]
    if not paths:
        return spark.createDataFrame([], f"path string, pos bigint, {', '.join(f'{c} string' for c in ARTICLE_COLUMNS)}")
    return read_batches_ordered(spark, paths)[0]


def seen_state(spark: SparkSession, root) -> DataFrame:
    """``site, category, id`` of the newest articles in JSON batches; only the picked files are read."""
    rows = _picked_rows(spark, root, state.state_file(list_batches(spark, root)))
    return state.parse_keys(state.recent_ids(rows)).select("site", "category", "id")


def resume_state(spark: SparkSession, root) -> DataFrame:
    """``site, category, last_id, last_batch`` of the last initial JSON batch; only those files are read."""
    rows = _picked_rows(spark, root, state.latest_batch(list_batches(spark, root)))
    return state.parse_keys(state.resume_point(rows)).select(
        "site", "category", "last_id", F.col("seq").alias("last_batch"))


def load_batches(spark: SparkSession, paths, published: str, mode: str = "append", run: str | None = None) -> DataFrame:
    """Publish JSON batch files that hold lists, as one run; returns the files that do not, which are left out.

    The run is named after the paths unless it is told, so the same load is there once however often it is started.
    """
    rows, rejects = read_batches_ordered(spark, paths, "PERMISSIVE", lists_only=True)
    named = sorted([paths] if isinstance(paths, str) else paths)
    with passing(spark):
        publish(rows.select(*ARTICLE_COLUMNS), published, run or run_name("load", named), mode)
    return rejects


# ---- runs on the lake

def _of_rules(source, rules, value, default):
    """A rule's value for the source of a row."""
    pairs = [F.lit(v) for r in rules for v in (r.source, value(r))]
    return F.coalesce(F.element_at(F.create_map(*pairs), source), F.lit(default)) if pairs else F.lit(default)


def _by_site(listing: DataFrame, rules) -> DataFrame:
    """With the folder of each source; a source without a rule is its own folder."""
    folder = F.coalesce(_of_rules(F.col("source"), rules, lambda r: r.folder, None), F.col("source"))
    return listing.withColumn("site", folder)


def publish_run(spark: SparkSession, root: str, run: str, published: str, mode: str = "append") -> None:
    """Publish what a committed run has stored; a run that is published already, or was never stored, is left alone."""
    chosen = lake.batch_manifest(spark, root).filter(F.col("run") == run)
    if not chosen.isEmpty():
        publish(lake.batch_rows(spark, root, chosen).select(*ARTICLE_COLUMNS), published, run, mode)


def _store_page_rejects(spark: SparkSession, root: str, run: str, pages: DataFrame, rules) -> None:
    """Of the run's articles without content, those whose page is missing, unreadable or without a rule (``page_rejects``).

    Only their pages are read again.
    """
    path = f"{root}/page_rejects/run={run}"
    chosen = lake.batch_manifest(spark, root).filter(F.col("run") == run)
    if exists(spark, f"{path}/_SUCCESS") or chosen.isEmpty():
        return
    empty = staged(lake.batch_rows(spark, root, chosen).filter(F.col("content") == NO_CONTENT).select("url", "source").distinct(), "empty")
    held = pages.join(empty.select("url"), "url", "left_semi")
    broken = page_rejects(held, rules).select("page_id", "url", "source", "reason")
    absent = empty.join(pages.select("url"), "url", "left_anti").select(
        F.lit(None).cast("bigint").alias("page_id"), "url", "source", F.lit("no page").alias("reason"))
    broken.unionByName(absent).write.mode("overwrite").parquet(path)


def run_page_rejects(spark: SparkSession, root: str) -> DataFrame:
    """``page_id, url, source, reason, run`` of the pages that runs could read no text from."""
    schema = "page_id bigint, url string, source string, reason string, run string"
    path = f"{root}/page_rejects"
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def run_incremental(spark: SparkSession, listing: DataFrame, pages: DataFrame, root: str, published: str, stamp: int,
                    rules=None, max_news: int | None = None, on_no_match: str = "rule", order=ORDER,
                    rejects: DataFrame | None = None, recent: int | None = None) -> str:
    """One scheduled run for all sources: cut at what is known, details, lake, published table. Returns the run's name.

    ``stamp`` names the run. One that stopped anywhere is started again with the same stamp and goes on from there:
    rows are stored once and published once, and its own rows never count as known. By default a run ends at any
    stored article and has no limit; ``recent`` looks at the first so many of the last batch only, ``max_news`` limits
    the rows. ``on_no_match="rule"`` does with a listing that ends before a known article as the source's rule says;
    a site and category without any stored article is always taken. Nothing new, nothing written.
    """
    rules, run = RULES if rules is None else rules, f"incremental_{stamp}"
    with passing(spark):
        if not lake.committed(spark, root, run):
            rows = _by_site(listing, rules)
            marks = None if rejects is None else _by_site(rejects, rules)
            begun = staged(lake.begun(spark, root, stamp).withColumn("_begun", F.lit(True)), "begun")
            # Only ids that the listing or its rejects show can end it.
            shown = rows.select(*SITE, "id") if marks is None else rows.select(*SITE, "id").union(marks.select(*SITE, "id"))
            shown = staged(shown.distinct(), "shown")
            known = lake.known_among(spark, root, shown, stamp) if recent is None \
                else attach(lake.known_ids(spark, root, stamp, recent), shown, [*SITE, "id"], "left_semi")
            if on_no_match == "rule":
                keep = _of_rules(F.col("source"), rules, lambda r: r.on_no_match, "keep") == "keep"
                on_no_match = F.col("_begun").isNull() | keep
            fresh = take_until_seen(attach(rows, begun, SITE), known, max_news, on_no_match, SITE, order, marks)
            fresh = staged(fresh.drop("_begun"), "fresh")
            if not fresh.isEmpty():
                wanted = pages.join(fresh.select("url"), "url", "left_semi")
                found = _articles(fresh, extract_articles(wanted, rules), (*SITE, "rn"))
                lake.write_batch_rows(found.withColumns({"batch_no": F.lit(stamp), "pos": F.col("rn") - 1}), root, run, "incremental")
        _store_page_rejects(spark, root, run, pages, rules)
        publish_run(spark, root, run, published)
    return run


def run_full(spark: SparkSession, listing: DataFrame, pages: DataFrame, root: str, rules=None, order=ORDER,
             rejects: DataFrame | None = None, run: str | None = None) -> str:
    """A full run for all sources: resume where the last batch ended, number, details, lake. Returns the run's name.

    Batches count once the whole run is stored, so one that stopped half-way begins anew from the same place; started
    again under the name of a stored ``run`` it does nothing.
    """
    rules, run = RULES if rules is None else rules, run or f"full_{uuid.uuid4().hex}"
    with passing(spark):
        if not lake.committed(spark, root, run):
            last = staged(lake.resume_points(spark, root), "resume")
            marks = None if rejects is None else _by_site(rejects, rules)
            rest = resume_after(_by_site(listing, rules), last, SITE, order, marks)
            whole = _of_rules(F.col("source"), rules, lambda r: r.remainder, "count") == "full"
            size = _of_rules(F.col("source"), rules, lambda r: r.batch_size, BATCH_SIZE)
            numbered = staged(assign_batches(rest, size, last, SITE, order, whole).withColumn("_size", size), "numbered")
            if not numbered.isEmpty():
                wanted = pages.join(numbered.select("url"), "url", "left_semi")
                found = _articles(numbered, extract_articles(wanted, rules), (*SITE, "batch_no", "rn", "_size"))
                lake.write_batch_rows(found.withColumn("pos", (F.col("rn") - 1) % F.col("_size")), root, run, "initial")
        _store_page_rejects(spark, root, run, pages, rules)
    return run


def run_from_pages(spark: SparkSession, listing_pages: DataFrame, pages: DataFrame, root: str, published: str, stamp: int,
                   rules=None, tz_policy: str = "wall", **options) -> DataFrame:
    """From listing pages to the published table in one run; returns the cards left out, with the reason.

    ``listing_pages(page_id, source, category, html)`` come newest first. The rejects are stored beside the run, and end
    a listing like any known card.
    """
    order = ("page_id", "pos")
    run = f"incremental_{stamp}"
    path = f"{root}/rejects/run={run}"
    with passing(spark):
        cards = staged(listing_cards(listing_pages, rules, tz_policy), "cards")
        cards.filter(F.col("reject_reason").isNotNull()).write.mode("overwrite").parquet(path)
        left = spark.read.schema(cards.schema).parquet(path)
        run_incremental(spark, cards.filter(F.col("reject_reason").isNull()).drop("reject_reason"), pages, root, published,
                        stamp, rules, order=order, rejects=left, **options)
    return left


def run_api_full(spark: SparkSession, answers: DataFrame, source: str, root: str, rules=None, column: str = "response",
                 page: str | None = None, page_size: int = 1000, run: str | None = None) -> str:
    """A full run from search answers: each answer is a batch, numbered by the hits that a page holds."""
    rules, run = RULES if rules is None else rules, run or f"api_{uuid.uuid4().hex}"
    with passing(spark):
        if not lake.committed(spark, root, run):
            number = F.col(page).cast("bigint") if page else F.lit(0).cast("bigint")
            hits = articles_from_hits(answers.withColumn("_page", number), source, column, ("_page",))
            rows = _by_site(hits, rules).withColumns({
                "batch_no": (F.col("_page") + 1) * page_size, "category": F.lit(None).cast("string")})
            rows = staged(rows, "hits")
            if not rows.isEmpty():
                lake.write_batch_rows(fill_defaults(rows), root, run, "initial")
    return run
