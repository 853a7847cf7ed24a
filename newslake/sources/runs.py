"""Tables that grow by runs: each run writes a folder of its own and counts once its manifest stands.

    {path}/data/run={run}/...         the rows of a run, partitioned by some of their columns
    {path}/manifest/run={run}/        one small file, written last: a summary of the rows
    {path}/packs/pack={name}/...      rows of many runs, laid out anew in few files by ``compact``
    {path}/snapshots/number={n}/      one file, written last: the summaries of all runs that packs hold
    {path}/sketch/{run=...|pack=...}/ which ids a run or pack may hold, as the words of a Bloom filter

A run that is repeated replaces its folder, so it never doubles; one that ended half-way has no manifest, so nobody
reads it. Readers open the packs of the newest snapshot and the runs that it does not cover, by name; no folder of the
rows is listed as a whole. Batch jobs and streams write the same layout. A run or pack is a ``part``.
"""

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslake.session import child_names, delete, exists, staged

# Two words of 64 bits for each id, four ids a word on average, four bits an id and word: a part that does not hold an
# id is opened for it about twice in a hundred thousand times.
_IDS_A_WORD = 4
_BITS = 4


def _checked(run: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", run):
        raise ValueError(f"a run's name holds letters, digits, dots, dashes and underscores, not {run!r}")
    return run


def _with(schema: str, *names: str) -> T.StructType:
    return T.StructType([*(T.StructType.fromDDL(schema).fields if schema else []), *(T.StructField(n, T.StringType()) for n in names)])


def _snapshot(spark: SparkSession, path: str) -> int | None:
    """The number of the newest snapshot that stands."""
    numbers = sorted((int(n.split("=")[1]) for n in child_names(spark, f"{path}/snapshots")), reverse=True)
    return next((n for n in numbers if exists(spark, f"{path}/snapshots/number={n}/_SUCCESS")), None)


def manifest(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The summaries of all committed runs, with ``run`` and the ``part`` that holds their rows."""
    young = _with(schema, "run")
    young = spark.read.schema(young).parquet(f"{path}/manifest") if exists(spark, f"{path}/manifest") \
        else spark.createDataFrame([], young)
    young = young.withColumn("part", F.concat(F.lit("run="), "run"))
    number = _snapshot(spark, path)
    if number is None:
        return young
    packed = spark.read.schema(_with(schema, "run", "part")).parquet(f"{path}/snapshots/number={number}")
    return packed.unionByName(young.join(packed.select("run").distinct(), "run", "left_anti"))


def committed(spark: SparkSession, path: str, run: str) -> bool:
    """Does the run's manifest stand? A run without rows has none."""
    folder = f"{path}/manifest/run={_checked(run)}"
    if exists(spark, folder) and not spark.read.schema("rows bigint").parquet(folder).isEmpty():
        return True
    return _snapshot(spark, path) is not None and not manifest(spark, path, "").filter(F.col("run") == run).isEmpty()


# ---- writing

def write_run(rows: DataFrame, path: str, run: str, partition_by, summary, sketch=None) -> None:
    """Write ``rows`` as the run, then its manifest ``summary(rows)``, which has a row for each partition at most.

    With ``sketch=(groups, id)`` the ids of each group, which are columns of the manifest too, are sketched as well; the
    summary then needs their number, ``rows``.
    """
    part = f"run={_checked(run)}"
    # Large partitions spread over several files, small ones share a task.
    rows.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/data/{part}")
    written = rows.sparkSession.read.schema(rows.schema).parquet(f"{path}/data/{part}")
    summed = summary(written)
    if sketch:
        summed = staged(summed, "summary")
        _write_sketch(written, summed.withColumn("part", F.lit(part)), path, part, *sketch)
    summed.coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/{part}")


def compact(spark: SparkSession, path: str, schema: str, manifest_schema: str, partition_by, sketch=None, most: float = 2.0) -> int:
    """Lay the rows of young runs out anew, with packs that are not much larger; returns how many parts went into that.

    A pack has one file for each partition, or several where a partition is large. Packs with up to ``most`` times the rows
    gathered so far go along, so their number grows with the logarithm of the rows, and a row is written anew as often.
    The snapshot that names the new pack is written last. What the snapshot before no longer needed is deleted then, so a
    query that began before this compaction still finds its files.
    """
    catalog = staged(manifest(spark, path, manifest_schema), "catalog")
    sizes = {r.part: r.n for r in catalog.groupBy("part").agg(F.sum("rows").alias("n")).collect()}
    chosen = [p for p in sizes if p.startswith("run=")]
    gathered = sum(sizes[p] for p in chosen)
    for pack in sorted((p for p in sizes if p.startswith("pack=")), key=sizes.get):
        if chosen and sizes[pack] <= most * gathered:
            chosen.append(pack)
            gathered += sizes[pack]
    if len(chosen) < 2:
        return 0
    before, name = _snapshot(spark, path), f"pack={uuid.uuid4().hex}"
    rows = _open(spark, path, schema, chosen)
    rows.hint("rebalance", *partition_by).write.partitionBy(*partition_by).parquet(f"{path}/packs/{name}")
    moved = catalog.withColumn("part", F.when(F.col("part").isin(chosen), name).otherwise(F.col("part")))
    if sketch:
        _write_sketch(_open(spark, path, schema, [name]), moved, path, name, *sketch)
    moved.coalesce(1).write.parquet(f"{path}/snapshots/number={(before or 0) + 1}")
    if before is not None:
        _clean(spark, path, before)
    return len(chosen)


def _clean(spark: SparkSession, path: str, number: int) -> None:
    """Delete what snapshot ``number`` has replaced: earlier snapshots, runs that it covers, packs that it does not name."""
    held = spark.read.schema("run string, part string").parquet(f"{path}/snapshots/number={number}").distinct().collect()
    runs = {f"run={r.run}" for r in held}
    packs = {r.part for r in held}
    newer = parts_of(manifest(spark, path, ""))
    gone = [f"snapshots/{n}" for n in child_names(spark, f"{path}/snapshots") if int(n.split("=")[1]) < number]
    # A run's manifest goes before its rows: who still finds it finds them too.
    gone += [f"{folder}/{n}" for folder in ("manifest", "data", "sketch") for n in child_names(spark, f"{path}/{folder}") if n in runs]
    gone += [f"{folder}/{n}" for folder in ("packs", "sketch") for n in child_names(spark, f"{path}/{folder}")
             if n.startswith("pack=") and n not in packs and n not in newer]
    for folder in gone:
        delete(spark, f"{path}/{folder}")


# ---- reading

def parts_of(summaries: DataFrame) -> set:
    """The names of the parts in a few summaries."""
    return {r.part for r in summaries.select("part").collect()}


def _open(spark: SparkSession, path: str, schema: str, parts) -> DataFrame:
    """The rows of the named parts, with their ``run``."""
    whole, found = _with(schema, "run"), []
    for folder, kind in (("data", "run="), ("packs", "pack=")):
        named = [f"{path}/{folder}/{p}" for p in sorted(parts) if p.startswith(kind)]
        if named:
            found.append(spark.read.schema(whole).option("basePath", f"{path}/{folder}").parquet(*named).select(*whole.names))
    if not found:
        return spark.createDataFrame([], whole)
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])


def read_runs(spark: SparkSession, path: str, schema: str, chosen: DataFrame | None = None, parts=None) -> DataFrame:
    """The rows of all committed runs, of the ``chosen(run)``, or of the named parts; other folders are not opened.

    The names of parts pass the driver: one for each young run and pack.
    """
    if chosen is None:
        if parts is None:
            parts = parts_of(manifest(spark, path, ""))
        return _open(spark, path, schema, parts)
    wanted = manifest(spark, path, "").join(chosen.select("run"), "run", "left_semi").select("part", "run").collect()
    rows = _open(spark, path, schema, {r.part for r in wanted if parts is None or r.part in parts})
    # A run's folder holds nothing else; a pack holds others too.
    if all(r.part.startswith("run=") for r in wanted):
        return rows
    return rows.join(spark.createDataFrame([(r.run,) for r in wanted], "run string").distinct(), "run", "left_semi")


# ---- which parts may hold an id

def _words(rows: Column) -> Column:
    return F.greatest(F.ceil(rows / _IDS_A_WORD), F.lit(1)).cast("bigint")


def _marks(groups, id_column: str, words: Column):
    """For an id two words and the bits that it sets in each, as an array of ``(word, bits)``."""
    key = [F.coalesce(F.col(c), F.lit("")) for c in (*groups, id_column)]

    def mark(seed):
        place, shape = F.xxhash64(F.lit(2 * seed), *key), F.xxhash64(F.lit(2 * seed + 1), *key)
        bits = [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(shape, 8 * k).bitwiseAND(63).cast("int"))
                for k in range(_BITS)]
        together = bits[0]
        for b in bits[1:]:
            together = together.bitwiseOR(b)
        return F.struct((F.pmod(place, words) * 2 + seed).alias("word"), together.alias("bits"))
    return F.array(mark(0), mark(1))


def _sizes(summaries: DataFrame, groups) -> DataFrame:
    """How many words the filter of each part and group has."""
    return summaries.groupBy("part", *groups).agg(_words(F.sum("rows")).alias("words"))


def _joined(left: DataFrame, right: DataFrame, columns, how="inner") -> DataFrame:
    on = [left[c].eqNullSafe(right[c]) for c in columns]
    return left.join(right, on, how).drop(*[right[c] for c in columns])


def _write_sketch(rows: DataFrame, summaries: DataFrame, path: str, part: str, groups, id_column: str) -> None:
    """The words of the filter of each group; bits are joined in each task before anything is shuffled."""
    sizes = _sizes(summaries.filter(F.col("part") == part), groups).drop("part")
    marked = _joined(rows.select(*groups, id_column), sizes, groups).select(
        *groups, F.explode(_marks(groups, id_column, F.col("words"))).alias("m"))
    words = marked.groupBy(*groups, F.col("m.word").alias("word")).agg(F.bit_or("m.bits").alias("bits"))
    words.write.mode("overwrite").parquet(f"{path}/sketch/{part}")


def parts_holding(spark: SparkSession, path: str, keys: DataFrame, summaries: DataFrame, groups, id_column: str) -> list:
    """The parts of ``summaries(part, groups, rows)`` that may hold one of the ``keys(groups, id)``; a part without a sketch may.

    Each key meets the parts that have its group, by the words it would have set there; the filters are read, about eight
    bytes for an id, not the rows.
    """
    known = parts_of(summaries)
    sketched = known & set(child_names(spark, f"{path}/sketch"))
    if not sketched:
        return sorted(known)
    sizes = _sizes(summaries.filter(F.col("part").isin(sorted(sketched))), groups)
    asked = _joined(keys.select(*groups, id_column).distinct(), sizes, groups).select(
        "part", *groups, id_column, F.explode(_marks(groups, id_column, F.col("words"))).alias("m"))
    asked = asked.select("part", *groups, id_column, F.col("m.word").alias("word"), F.col("m.bits").alias("asked"))
    schema = T.StructType([*(T.StructField(c, T.StringType()) for c in groups), *T.StructType.fromDDL("word bigint, bits bigint").fields])
    found = None
    for kind in ("run", "pack"):
        folders = [f"{path}/sketch/{p}" for p in sorted(sketched) if p.startswith(f"{kind}=")]
        if folders:
            words = spark.read.schema(T.StructType([*schema.fields, T.StructField(kind, T.StringType())])).option(
                "basePath", f"{path}/sketch").parquet(*folders).withColumn("part", F.concat(F.lit(f"{kind}="), kind)).drop(kind)
            found = words if found is None else found.unionByName(words)
    met = _joined(asked, found, ["part", *groups, "word"]).filter(F.col("bits").bitwiseAND(F.col("asked")) == F.col("asked"))
    both = met.groupBy("part", *groups, id_column).agg(F.count("*").alias("n")).filter("n = 2")
    return sorted((known - sketched) | parts_of(both.select("part").distinct()))
