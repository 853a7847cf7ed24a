"""Scalar text expressions. All are built-in functions, so they stay inside generated code."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space, Unicode's and the four ASCII separators.
WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) \
    + "\u2028\u2029\u202f\u205f\u3000"


def url_id(url: Column) -> Column:
    """Identity of an article: MD5 of the URL's UTF-8 bytes, as lower-case hex."""
    return F.md5(url)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE))


def has_text(text: Column) -> Column:
    """Is there a visible character? Looks no further than the first one."""
    return text.rlike(f"[^{WHITE}]")


def squeeze(text: Column) -> Column:
    """Strip, and make every inner run of white space one blank, as a browser shows the text."""
    # The named class is far faster than the same characters listed one by one.
    return strip(F.regexp_replace(text, r"(?U)[\s\x1c-\x1f]+", " "))


def remove_all(text: Column, *literals: str) -> Column:
    return reduce(lambda acc, lit: F.replace(acc, F.lit(lit), F.lit("")), literals, text)


def drop_dashes(text: Column) -> Column:
    """Remove every run of two or more dashes."""
    return F.regexp_replace(text, "-{2,}", "")


def join_lines(text: Column) -> Column:
    return F.replace(text, F.lit("\n"), F.lit(" "))


def part_before(text: Column, mark: str) -> Column:
    return strip(F.split_part(text, F.lit(mark), F.lit(1)))


def last_part(text: Column, mark: str) -> Column:
    return F.split_part(text, F.lit(mark), F.lit(-1))


def absolute_url(base: str, href: Column) -> Column:
    return F.concat(F.lit(base), href)


def contains_any(text: Column, phrases) -> Column:
    return reduce(lambda acc, p: acc | F.contains(text, F.lit(p)), phrases, F.lit(False))


def to_int(text: Column) -> Column:
    """A whole number that may hold thousands separators; anything else is NULL."""
    return F.replace(strip(text), F.lit(","), F.lit("")).try_cast("bigint")


def drop_phrase_paragraphs(paragraphs: Column, phrases) -> Column:
    """Join the paragraphs that hold none of the phrases; blank ones vanish."""
    cleaned = F.transform(paragraphs, strip)
    return F.array_join(F.filter(cleaned, lambda p: (p != "") & ~contains_any(p, phrases)), " ")


def or_default(value: Column, default: str, blank_is_missing: bool = True) -> Column:
    """``default`` for NULL and, by choice, for text without any visible character."""
    present = F.when(has_text(value), value) if blank_is_missing else value
    return F.coalesce(present, F.lit(default))
