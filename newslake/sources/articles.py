"""Readers: JSON batches with and without order, batch keys, search answers, raw pages."""

import codecs

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import newslake
from newslake.functions import dates, text
from newslake.operators import state
from newslake.schema import ARTICLE_COLUMNS, ARTICLE_SCHEMA, HITS_SCHEMA
from newslake.session import staged
from newslake.sources.jsonranges import read_records
from newslake.sources.jsontext import objects, values
from newslake.sources.stores import open_store

# The helper travels with the tasks, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(newslake)

# Objects named by hand end in .json; our batch sink writes through Spark's text files.
_BATCH_FILES = "{*.json,part-*.txt}"
# Files below so many bytes are read as one value.
WHOLE_BELOW = 16 << 20
_CHUNK = 1 << 20


def read_articles(spark: SparkSession, paths, layout: str = "array", recursive: bool = True) -> DataFrame:
    """Article JSON with the fixed schema; malformed text fails the job.

    ``layout="array"`` reads one array or object per file, ``"lines"`` one object per line. They do
    not mix: an array reader sees only the first line of a lines file.
    """
    if layout not in ("array", "lines"):
        raise ValueError(f"layout must be 'array' or 'lines', not {layout!r}")
    return (
        spark.read.schema(ARTICLE_SCHEMA).option("mode", "FAILFAST").option("encoding", "UTF-8")
        .option("multiLine", layout == "array").option("recursiveFileLookup", recursive).json(paths)
    )


def parse_batch(value: Column, article=ARTICLE_SCHEMA) -> Column:
    """A batch's text as an array of articles: an object is an array of one, other shapes are NULL."""
    element = T.StructType.fromDDL(article) if isinstance(article, str) else article
    return F.from_json(value, T.ArrayType(element), {"mode": "PERMISSIVE"})


def _chunks(path: str):
    """The text of a file in chunks."""
    store, name = open_store(path)
    decode = codecs.getincrementaldecoder("utf-8")("replace").decode
    with store.open_input_stream(name) as file:
        while data := file.read(_CHUNK):
            yield decode(data)
    yield decode(b"", True)


def _arrays(path: str):
    """A file's articles as the texts of arrays of about a chunk, ``(kind, array, problem)``; a file with a problem gives no array."""
    def drained(found):
        while True:
            try:
                next(found)
            except StopIteration as end:
                return end.value

    kind, problem = drained(objects(_chunks(path)))
    if problem:
        yield None, None, problem
        return
    held, size = [], 0
    for text in objects(_chunks(path)):
        held.append(text)
        size += len(text)
        if size >= _CHUNK:
            yield kind, f"[{','.join(held)}]", None
            held, size = [], 0
    if held:
        yield kind, f"[{','.join(held)}]", None


def split_values(files: DataFrame) -> DataFrame:
    """``files(path, value)``, whole texts, with ``kind`` and the articles as one array's text, or the ``problem``.

    Works on streams too. A text is one row here, so it has to fit a task; lines of any number are read by
    ``read_articles(layout="lines")``, which splits files. With a column ``whole``, a file where it is false has no text
    here: its task reads it in chunks, twice, and gives arrays of about a chunk in as many rows.
    """
    def run(batches):
        for batch in batches:
            out, size = [], 0
            # One text at a time, and rows go out as they come.
            for path, value, whole in zip(*(batch.column(i) for i in range(3))):
                path = path.as_py()
                text = value.as_py() if whole.as_py() else None
                found = _arrays(path) if not whole.as_py() else [values(text) if text is not None else (None, None, "empty")]
                for row in found:
                    out.append((path, *row))
                    size += len(row[1] or "")
                    if size >= 4 * _CHUNK:
                        yield batch_of(out)
                        out, size = [], 0
            if out:
                yield batch_of(out)

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], ["path", "kind", "value", "problem"])

    whole = F.col("whole") if "whole" in files.columns else F.lit(True)
    return files.select("path", "value", whole.alias("whole")).mapInArrow(run, "path string, kind string, value string, problem string")


def plain_path(path: Column) -> Column:
    """A file's path as a listing shows it; the metadata column has it as a URI."""
    return F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)


def parse_files(files: DataFrame, article=ARTICLE_SCHEMA, lists_only: bool = False) -> DataFrame:
    """One row per file: path, parsed array ``rows``, and the ``problem`` of a file that gives none; several rows for a file
    that is not ``whole`` (``split_values``).

    A lone object and JSON lines count as a list, unless ``lists_only`` is set.
    """
    parsed = split_values(files).withColumn("rows", parse_batch(F.col("value"), article))
    problem = F.coalesce("problem", F.when(F.col("rows").isNull(), "broken JSON"))
    if lists_only:
        problem = F.coalesce(problem, F.when(F.col("kind") != "list", "no list"))
    return parsed.select("path", F.when(problem.isNull(), F.col("rows")).alias("rows"), problem.alias("problem"))


def read_batch_files(spark: SparkSession, paths, article=ARTICLE_SCHEMA, recursive: bool = True,
                     lists_only: bool = False) -> DataFrame:
    """One row per batch file: its path, its articles, or its problem."""
    files = (
        spark.read.option("recursiveFileLookup", recursive).option("pathGlobFilter", _BATCH_FILES)
        .text(paths, wholetext=True)
    )
    return parse_files(files.select(plain_path(F.col("_metadata.file_path")).alias("path"), "value"), article, lists_only)


def explode_files(files: DataFrame):
    """Articles with their file and place in it, and the files with a problem."""
    rows = files.select("path", F.posexplode("rows").alias("pos", "row")).select(
        "path", F.col("pos").cast("bigint").alias("pos"), "row.*")
    return rows, files.filter(F.col("problem").isNotNull()).select("path", "problem")


def read_batches_ordered(spark: SparkSession, paths, mode: str = "FAILFAST", recursive: bool = True,
                         lists_only: bool = False):
    """Articles with their file and place in it, and the files that hold no articles, with their problem.

    With ``mode="FAILFAST"`` such a file fails the job; with ``"PERMISSIVE"`` the caller looks at the rejects.
    """
    if mode not in ("FAILFAST", "PERMISSIVE"):
        raise ValueError(f"mode must be 'FAILFAST' or 'PERMISSIVE', not {mode!r}")
    files = read_batch_files(spark, paths, recursive=recursive, lists_only=lists_only)
    if mode == "FAILFAST":
        error = F.raise_error(F.concat(F.col("path"), F.lit(": "), F.col("problem")))
        files = files.withColumn("rows", F.coalesce("rows", error.cast(files.schema["rows"].dataType)))
    return explode_files(files)


def read_files(spark: SparkSession, paths, article=ARTICLE_SCHEMA, recursive: bool = True, whole_below: int = WHOLE_BELOW):
    """Articles of batch files of any size with their file and place in it, and the files that hold none, with their problem.

    Files below ``whole_below`` bytes are one row each (``read_batch_files``); larger ones are read by ranges of bytes, so
    many tasks share a file (``jsonranges``). Results are the same.
    """
    element = T.StructType.fromDDL(article) if isinstance(article, str) else article
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", recursive).option("pathGlobFilter", _BATCH_FILES)
        .load(paths)
    )
    # Names of large files pass the driver, not one for each hundred rows.
    large = [r.path for r in listed.filter(F.col("length") >= whole_below).select("path").collect()]
    # Both parts come from one listing; the filter goes down to it, so large files are not opened here.
    texts = listed.filter(F.col("length") < whole_below).withColumn("value", F.col("content").cast("string"))
    rows, rejects = explode_files(staged(parse_files(
        texts.select(plain_path(F.col("_metadata.file_path")).alias("path"), "value"), element), "files"))
    if large:
        records, broken = read_records(spark, large)
        rows = rows.unionByName(records.select(
            plain_path(F.col("path")).alias("path"), "pos", F.from_json("value", element, {"mode": "PERMISSIVE"}).alias("row"))
            .select("path", "pos", "row.*"))
        rejects = rejects.unionByName(broken.select(plain_path(F.col("path")).alias("path"), "problem"))
    return rows, rejects


def list_batches(spark: SparkSession, root) -> DataFrame:
    """The batches below ``root`` with site, category, kind and number; contents are not read.

    A folder that does not exist yet has no batches.
    """
    try:
        files = (
            spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .option("pathGlobFilter", _BATCH_FILES).load(root).select("path", "length")
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], "path string, length bigint")
    return state.parse_keys(files)


def articles_from_hits(answers: DataFrame, source: str, column: str = "response", keep=()) -> DataFrame:
    """Articles of search answers ``{"hits": [{post_title, post_date, permalink, content}]}``.

    With columns of the answer to ``keep``, these and the hit's place in it, ``pos``, come along.
    """
    hits = answers.select(*keep, F.posexplode(F.from_json(column, HITS_SCHEMA)["hits"]).alias("pos", "hit"))
    fields = {
        "content": F.col("hit.content"),
        "id": text.url_id(F.col("hit.permalink")),
        "published_at": dates.epoch_to_text(F.col("hit.post_date")),
        "source": F.lit(source),
        "title": F.col("hit.post_title"),
        "url": F.col("hit.permalink"),
    }
    place = [*keep, F.col("pos").cast("bigint").alias("pos")] if keep else []
    return hits.select(*place, *[fields[c].alias(c) for c in ARTICLE_COLUMNS])


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("page_id", "url", "html")
