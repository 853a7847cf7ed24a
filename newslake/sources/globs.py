"""Many inputs in one scan: which of the globs a file belongs to, from its path alone."""

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake.session import matches
from newslake.sources.articles import plain_path, read_articles

_WILD = re.compile(r"[*?{\[\\]")


def _bare(path: str) -> str:
    """A local path without its scheme; others as they are."""
    return re.sub(r"^file:/+", "/", path).rstrip("/")


def glob_pattern(glob: str) -> str:
    """A regular expression for the files that a glob names, or that lie below a folder that it names."""
    out, at, depth = [], 0, 0
    text = _bare(glob)
    while at < len(text):
        c = text[at]
        if c == "\\" and at + 1 < len(text):
            at += 1
            out.append(re.escape(text[at]))
        elif c == "*":
            out.append("[^/]*")
        elif c == "?":
            out.append("[^/]")
        elif c == "{":
            depth += 1
            out.append("(?:")
        elif c == "}" and depth:
            depth -= 1
            out.append(")")
        elif c == "," and depth:
            out.append("|")
        elif c == "[" and "]" in text[at + 2:]:
            end = text.index("]", at + 2)
            inner = text[at + 1:end].replace("\\", "\\\\").replace("[", "\\[")
            out.append(f"[{'^' + inner[1:] if inner[0] in '!^' else inner}]")
            at = end
        else:
            out.append(re.escape(c))
        at += 1
    return f"^{''.join(out)}(?:/.*)?$"


def scan_root(glob: str) -> str:
    """The folder or file below which all that a glob names lies."""
    text = glob.rstrip("/")
    wild = _WILD.search(text)
    return text[:text.rindex("/", 0, wild.start())] or "/" if wild else text


def scan_roots(globs) -> list:
    """The roots of all globs, without those that lie below another: no file is listed twice."""
    roots = sorted({scan_root(g) for g in globs}, key=_bare)
    kept = []
    for root in roots:
        if not any(_bare(root) == _bare(k) or _bare(root).startswith(_bare(k).rstrip("/") + "/") for k in kept):
            kept.append(root)
    return kept


def inputs_of(path: Column, globs) -> Column:
    """The numbers of the globs that name a file, as an array."""
    bare = F.regexp_replace(plain_path(path), "^file:/+", "/")
    return F.array_compact(F.array(*[F.when(bare.rlike(glob_pattern(g)), F.lit(i)) for i, g in enumerate(globs)]))


def read_inputs(spark: SparkSession, globs, layout: str = "array") -> DataFrame:
    """The articles of all inputs with the number of their input, ``_input``, by one scan.

    A file that two inputs name counts for both, but is parsed once. Files below the common folders that no input names
    are not opened. An input that names nothing fails.
    """
    globs = list(globs)
    for glob in globs:
        if not matches(spark, glob):
            raise FileNotFoundError(f"no file matches {glob}")
    rows = read_articles(spark, scan_roots(globs), layout)
    named = rows.select("*", inputs_of(F.col("_metadata.file_path"), globs).alias("_inputs")).filter(F.size("_inputs") > 0)
    return named.withColumn("_input", F.explode("_inputs")).drop("_inputs")
