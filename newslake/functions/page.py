"""Extraction by built-in expressions, for pages of regular markup. Nothing here leaves the JVM.

The patterns use lazy or single-class repetition only, so matching does not recurse on long pages.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.functions.text import strip, to_int

# The entities that regular pages use. Names count with and without the semicolon.
ENTITIES = {"&lt": "<", "&gt": ">", "&quot": '"', "&nbsp": "\xa0", "&copy": "©", "&middot": "·",
            "&amp": "\x01", "&#39;": "'"}

# A script, a style, a comment, or a single tag.
_MARKUP = r"(?is)<(?:script\b.*?</script|style\b.*?</style|!--.*?--|[^>]*)>"


def unescape(text: Column) -> Column:
    """Decode the entities; text without an ampersand is left alone.

    Decoded ampersands wait as a control character, so that they start no further entity.
    """
    decoded = text
    for name, char in ENTITIES.items():
        for form in dict.fromkeys((name.rstrip(";") + ";", name)):
            decoded = F.replace(decoded, F.lit(form), F.lit(char))
    decoded = F.replace(decoded, F.lit("\x01"), F.lit("&"))
    return F.when(F.contains(text, F.lit("&")), decoded).otherwise(text)


def inner(html: Column, tag: str) -> Column:
    """What the first ``tag`` element holds; '' when there is none."""
    return F.regexp_extract(html, rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>", 1)


def drop_elements(html: Column, tag: str, class_name: str) -> Column:
    """Remove elements of a class that hold no element of their own kind."""
    return F.regexp_replace(html, rf'(?is)<{tag}[^>]*class="{class_name}"[^>]*>.*?</{tag}>', "")


def text_nodes(html: Column) -> Column:
    """What stands between markup: decoded, stripped, empty ones left out."""
    nodes = F.transform(F.split(html, _MARKUP), lambda node: strip(unescape(node)))
    return F.filter(nodes, lambda node: node != "")


def visible_text(html: Column) -> Column:
    """Text nodes, joined by one blank."""
    return F.array_join(text_nodes(html), " ")


def tight_text(html: Column) -> Column:
    """Text nodes with nothing between them."""
    return F.array_join(text_nodes(html), "")


def with_first_text(pages: DataFrame, name: str, default: str, *tags: str, html: str = "html") -> DataFrame:
    """Add the visible text of the first of the elements that has any, else ``default``.

    The elements' texts are columns of a projection of their own, so each is made once per row.
    """
    made = {f"_{name}_{i}": visible_text(inner(F.col(html), tag)) for i, tag in enumerate(tags)}
    first = F.coalesce(*[F.when(F.col(c) != "", F.col(c)) for c in made], F.lit(default))
    return pages.withColumns(made).withColumn(name, first).drop(*made)


def attribute(html: Column, tag: str, name: str) -> Column:
    """An attribute of the first ``tag`` that has it; NULL when none has."""
    return F.nullif(F.regexp_extract(html, rf'(?is)<{tag}\s[^>]*?\b{name}="([^"]*)"', 1), F.lit(""))


def link_targets(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(r'(?is)<li><a href="([^"]*)">'), F.lit(1))


def link_labels(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(r'(?is)<li><a href="[^"]*">(.*?)</a>'), F.lit(1))


def paragraphs(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(r"(?is)<p>(.*?)</p>"), F.lit(1))


def block_text(heading: Column, paragraph_array: Column) -> Column:
    """Heading, a blank, and the paragraphs that have text, joined by blanks."""
    lines = F.filter(F.transform(paragraph_array, tight_text), lambda p: p != "")
    return F.concat(heading, F.lit(" "), F.array_join(lines, " "))


def page_count(labels: Column) -> Column:
    """The number on the second last pagination link; 1 when there is none."""
    second_last = F.when(F.size(labels) >= 2, F.element_at(labels, -2))
    return F.coalesce(to_int(second_last), F.lit(1).cast("bigint"))
