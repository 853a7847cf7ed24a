"""Rule-driven extraction: pages to article fields, listing pages to cards.

One ``mapInArrow`` per operator reads only the columns it needs, takes one page after the other without
any shuffle, and emits raw text. Dates, ids, defaults and text steps are built-in expressions on top.
"""

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

import newslake
from newslake.functions import dates, text
from newslake.schema import NO_CONTENT, NO_DATE, NO_TITLE
from newslake.sources import html as H
from newslake.sources.rules import RULES, Rule, rule_map

# The helper and the rules travel with the tasks, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(newslake)

# Found rows go out by so many characters, or rows.
_HELD, _ROWS = 4 << 20, 10_000

_FIELDS = "page_id bigint, url string, source string, title string, content string, " \
          "published_raw string, notation string, other_raw string"
_CARDS = "page_id bigint, source string, category string, pos bigint, href string, title string, " \
         "published_raw string, notation string, complete boolean"


def _text(node, style):
    if style in ("tight", "spaced"):
        return ("" if style == "tight" else " ").join(H.strings(node))
    hidden = H.hidden_below(node)
    whole = "".join(t for t in H.walk(node, hidden) if isinstance(t, str))
    return whole.strip() if style == "raw" else " ".join(whole.split())


def _value(scope, field):
    """The field's attribute or text within ``scope``; None when there is no element."""
    found = []
    for selector in field.select.split(" ++ "):
        node = H.select_one(scope, selector)
        if node is None:
            return None
        if field.attr:
            return node.attrs.get(field.attr)
        piece = _text(node, field.text)
        if not any(piece in earlier for earlier in found):
            found.append(piece)
    return " ".join(found)


def _date_line(tree, field):
    """Of several marked lines the one that says "Published", else the last that is no update."""
    lines = [_text(n, field.text) for n in H.select(tree, field.select)]
    published = [line for line in lines if "Published" in line]
    others = [line for line in lines if "Updated" not in line]
    return published[0] if published else others[-1] if others else None


def _body(tree, roots):
    for root in roots:
        matches = H.select(tree, root.select)
        if not matches:
            continue
        if root.join == "each":
            return " ".join("".join(H.strings(m)) for m in matches)
        if root.join == "blocks":
            blocks = []
            for m in matches:
                heading = H.select_one(m, root.heading)
                name = "".join(H.strings(heading)) if heading is not None else NO_TITLE
                lines = ["".join(H.strings(p)) for p in H.select(m, "p")]
                blocks.append(name + " " + " ".join(line for line in lines if line))
            return "".join(blocks)
        top = matches[0]
        gone = set(H.select(top, root.drop)) if root.drop else set()
        if root.drop_phrases:
            for p in H.select(top, "p"):
                words = "".join(t for t in H.walk(p, gone) if isinstance(t, str))
                if any(phrase in words for phrase in root.drop_phrases):
                    gone.add(p)
        return " ".join(H.strings(top, gone))
    return None


def _map_pages(pages: DataFrame, find, schema: str) -> DataFrame:
    """The rows that ``find`` gives for each row of ``pages``. A task holds a batch as it came and one page's tree; found
    rows go out as they come."""
    def run(batches):
        kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
        columns = pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in schema.split(","))])

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), columns)], schema=columns)
        out, size = [], 0
        for batch in batches:
            for values in zip(*batch.columns):
                for row in find(*(v.as_py() for v in values)):
                    out.append(row)
                    size += sum(len(v) for v in row if isinstance(v, str))
                    if size >= _HELD or len(out) >= _ROWS:
                        yield batch_of(out)
                        out, size = [], 0
            if out:
                yield batch_of(out)
                out, size = [], 0

    return pages.mapInArrow(run, schema)


def _page_fields(html, rule):
    with H.parsed(html) as tree:
        return _tree_fields(tree, rule)


def _tree_fields(tree, rule):
    title = _value(tree, rule.title) if rule.title else None
    found = []
    for field in rule.dates:
        raw = (_date_line if field.notation == "D8" else _value)(tree, field)
        if raw is not None:
            found.append((raw, field.notation))
            if not rule.next_date_if_unreadable:
                break
    raw, notation = found[0] if found else (None, None)
    other = found[1][0] if len(found) > 1 else None
    return title, _body(tree, rule.roots), raw, notation, other


def _page_cards(html, rule):
    with H.parsed(html) as tree:
        return list(_tree_cards(tree, rule))


def _tree_cards(tree, rule):
    spec, pos = rule.cards, 0
    for selector in spec.select:
        selector, _, first = selector.partition(" !")
        nodes = H.select(tree, selector)
        for node in nodes[:1] if first else nodes:
            link = node.parent if spec.link == ".." else H.select_one(node, spec.link) if spec.link else node
            href = link.attrs.get("href") if link is not None else None
            title = _value(node, spec.title) if spec.title else None
            raw = _value(node, spec.date) if spec.date else None
            has_date = not spec.date or spec.date_optional or H.select_one(node, spec.date.select) is not None
            complete = (
                href is not None and has_date and (title is not None or not spec.title)
                and (not spec.required or H.select_one(node, spec.required) is not None)
            )
            yield pos, href, title, raw, spec.date.notation if spec.date else None, complete
            pos += 1


def _page_label(html, rule):
    """The text of the pagination link that holds the last page's number."""
    with H.parsed(html) as tree:
        links = H.select(tree, rule.pages)
        return " ".join(H.strings(links[-rule.page_link])) if len(links) >= rule.page_link else None


def _readable(html, rule):
    with H.parsed(html):
        return True


def _guarded(read, html, rule):
    """Markup that the parser refuses counts as a page without any field."""
    try:
        return read(html, rule)
    except AssertionError:
        return None


def _apply_text_steps(content: Column, source: Column, rules) -> Column:
    for rule in rules:
        if rule.text_steps:
            changed = content
            for step in rule.text_steps:
                if step == "newlines":
                    changed = text.join_lines(changed)
                elif step == "dashes":
                    changed = text.drop_dashes(changed)
                else:
                    changed = text.remove_all(changed, step)
            content = F.when(source == rule.source, changed).otherwise(content)
    return content


def _notations(rules):
    fields = [f for r in rules for f in (*r.dates, r.cards.date if r.cards else None) if f is not None]
    return sorted({f.notation for f in fields})


def _parsed(raw, rules, tz_policy):
    return dates.parse_by_notation(F.col(raw), F.col("notation"), _notations(rules), tz_policy)


def extract_fields(pages: DataFrame, rules=None) -> DataFrame:
    """Raw fields of ``pages(page_id, url, html, source)``: NULL where an element is missing.

    ``other_raw`` is a second date in the same notation, for rules that turn to it when the first is
    unreadable.

    Pages of a source without a rule are not read by Python at all; they yield no rows.
    """
    rules = RULES if rules is None else rules
    by_source = rule_map(rules)

    def find(page_id, url, html, source):
        fields = _guarded(_page_fields, html, by_source[source]) if html is not None else None
        yield page_id, url, source, *(fields or (None,) * 5)

    known = pages.select("page_id", "url", "html", "source").filter(F.col("source").isin(list(by_source)))
    raw = _map_pages(known, find, _FIELDS)
    return raw.withColumn("content", _apply_text_steps(F.col("content"), F.col("source"), rules))


def extract_articles(pages: DataFrame, rules=None, tz_policy: str = "wall") -> DataFrame:
    """Detail step: pages to ``page_id, id, url, source, title, content, published_at`` with defaults.

    ``title`` and ``published_at`` are NULL for sources that take them from the listing.
    """
    rules = RULES if rules is None else rules
    raw = extract_fields(pages, rules)
    blank = [r.source for r in rules if r.blank_is_missing]
    titled = [r.source for r in rules if r.title]
    dated = [r.source for r in rules if r.dates]
    content = F.coalesce(
        F.when(F.col("source").isin(blank) & (F.col("content") == ""), F.lit(NO_CONTENT)),
        F.col("content"), F.lit(NO_CONTENT),
    )
    parsed = _parsed("published_raw", rules, tz_policy)
    second = [r for r in rules if r.next_date_if_unreadable]
    if second:
        parsed = F.coalesce(parsed, _parsed("other_raw", second, tz_policy))
    return raw.select(
        "page_id",
        text.url_id(F.col("url")).alias("id"),
        "url",
        "source",
        F.when(F.col("source").isin(titled), F.coalesce("title", F.lit(NO_TITLE))).alias("title"),
        content.alias("content"),
        F.when(F.col("source").isin(dated), F.coalesce(parsed, F.lit(NO_DATE))).alias("published_at"),
    )


def extract_cards(pages: DataFrame, rules=None) -> DataFrame:
    """All cards of listing ``pages(page_id, source, category, html)`` in page order, complete or not."""
    rules = RULES if rules is None else rules
    by_source = {s: r for s, r in rule_map(rules).items() if r.cards}

    def find(page_id, source, category, html):
        cards = _guarded(_page_cards, html, by_source[source])
        # A page that the parser refuses is one row without a card.
        return ((page_id, source, category, *card) for card in (cards if cards is not None else [(None,) * 6]))

    known = pages.select("page_id", "source", "category", "html").filter(
        F.col("source").isin(list(by_source)) & F.col("html").isNotNull())
    return _map_pages(known, find, _CARDS)


def listing_cards(pages: DataFrame, rules=None, tz_policy: str = "wall") -> DataFrame:
    """The cards of listing pages with ``reject_reason``, which is NULL for listing rows; each page is parsed once.

    A row is rejected when its card lacks an element the source needs, its link is on the source's
    skip list, or its date, read in the listing, cannot be read. A page that is missing, that the parser refuses or
    whose source has no rule is one reject without a link.
    """
    rules = [r for r in (RULES if rules is None else rules) if r.cards]
    cards = extract_cards(pages, rules)
    source, href = F.col("source"), F.col("href")
    skipped, url, optional = F.lit(False), href, []
    for rule in rules:
        if rule.cards.skip_links:
            skipped = skipped | ((source == rule.source) & href.isin(list(rule.cards.skip_links)))
        if rule.cards.base_url:
            url = F.when(source == rule.source, text.absolute_url(rule.cards.base_url, href)).otherwise(url)
        if rule.cards.date_optional:
            optional.append(rule.source)
    parsed = _parsed("published_raw", rules, tz_policy)
    # Without its date element a card of these sources keeps the sentinel.
    parsed = F.when(source.isin(optional) & F.col("published_raw").isNull(), F.lit(NO_DATE)).otherwise(parsed)
    rows = cards.select(
        "source", "category", "page_id", "pos",
        # The identity is over the link as it stands on the page.
        text.url_id(href).alias("id"),
        url.alias("url"), "title",
        F.when(F.col("notation").isNotNull(), parsed).alias("published_at"),
        F.when(F.col("complete").isNull(), "unreadable page")
        .when(skipped, "skipped link").when(~F.col("complete"), "incomplete card")
        .when(F.col("notation").isNotNull() & parsed.isNull(), "unreadable date").alias("reject_reason"),
    )
    nothing = F.lit(None)
    ruled = F.coalesce(source.isin([r.source for r in rules]), F.lit(False))
    unread = pages.filter(~ruled | F.col("html").isNull()).select(
        "source", "category", "page_id", nothing.cast("bigint").alias("pos"), *(nothing.cast("string").alias(c) for c in ("id", "url", "title", "published_at")),
        F.when(~ruled, "no rule").otherwise("no page").alias("reject_reason"))
    return rows.unionByName(unread)


def explode_listing(pages: DataFrame, rules=None, tz_policy: str = "wall"):
    """Listing rows, and rejects with their reason (``listing_cards``). Who needs both should stage the cards instead, as
    each of the two parses the pages."""
    cards = listing_cards(pages, rules, tz_policy)
    return cards.filter(F.col("reject_reason").isNull()).drop("reject_reason"), cards.filter(F.col("reject_reason").isNotNull())


def page_rejects(pages: DataFrame, rules=None) -> DataFrame:
    """``page_id, url, source, reason`` of article pages that no text can be read from."""
    by_source = rule_map(RULES if rules is None else rules)

    def find(page_id, url, source, html):
        if not _guarded(_readable, html, None):
            yield page_id, url, source, "unreadable page"

    columns = ["page_id", "url", "source"]
    ruled = F.coalesce(F.col("source").isin(list(by_source)), F.lit(False))
    unread = pages.filter(~ruled | F.col("html").isNull()).select(*columns, F.when(~ruled, "no rule").otherwise("no page").alias("reason"))
    return unread.unionByName(_map_pages(pages.filter(ruled & F.col("html").isNotNull()).select(*columns, "html"), find,
                                         "page_id bigint, url string, source string, reason string"))


def last_page(pages: DataFrame, rules=None) -> DataFrame:
    """Last page number of listing ``pages(page_id, source, html)``.

    The rule says which pagination link holds it, and which number stands for an unreadable or missing one.
    """
    by_source = {r.source: r for r in (RULES if rules is None else rules) if r.pages}

    def find(page_id, source, html):
        rule = by_source[source]
        yield page_id, source, _guarded(_page_label, html, rule) if html is not None else None, rule.page_fallback

    known = pages.select("page_id", "source", "html").filter(F.col("source").isin(list(by_source)))
    return _map_pages(known, find, "page_id bigint, source string, label string, fallback int").select(
        "page_id", "source", F.coalesce(text.to_int(F.col("label")), "fallback").alias("pages"))
