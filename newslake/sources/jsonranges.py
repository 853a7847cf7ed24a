"""Large JSON files read by byte ranges: any number of tasks read one file, whether it has lines or not.

Spark's text reader splits a file at any separator, so a file is read as the pieces between closing braces, by ranges
of bytes. Whether a brace stands in a string, and how deep, depends on all that came before. So each range first tells
what it does to a state it does not know yet: for a start inside and outside of a string the end, the change of depth,
and how many braces close at which depth. These are composed from range to range (``range_starts``), and with its start
known each range then gives its records; one that crosses ranges is put together from its parts.
"""

import json
import re

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import newslake
from newslake.session import staged

cloudpickle.register_pickle_by_value(newslake)

_ESCAPE = re.compile(r"\\.", re.DOTALL)
_BLANK, _ORDER_MARK = " \t\r\n", "\ufeff"
# So many ranges are started from one broadcast table of about 200 bytes each.
_RANGES_AT_ONCE = 100_000

_SUMMARY = "path string, start bigint, size bigint, octets bigint, first string, broken boolean, " \
    "ends array<int>, changes array<bigint>, closings array<map<bigint,bigint>>"
_STARTS = "path string, start bigint, inside boolean, depth bigint, pos bigint, base int, last boolean, brace boolean, problem string"
_RECORDS = "path string, pos bigint, start bigint, value string, part boolean, problem string"


class Scan:
    """What a piece of JSON without closing braces outside of strings does."""

    __slots__ = ("broken", "swaps", "changes")

    def __init__(self, text: str):
        bare = _ESCAPE.sub("", text) if "\\" in text else text
        # An escape that is cut off would escape the brace, which JSON does not know.
        self.broken = bare.endswith("\\")
        parts = bare.split('"')
        self.swaps = len(parts) % 2 == 0
        sides = ("".join(parts[0::2]), "".join(parts[1::2]))
        self.changes = [s.count("{") + s.count("[") - s.count("]") for s in sides]


class Summary:
    """The effect of a range's pieces for a start outside (0) and inside (1) of a string; the brace that ends the last
    piece is left to whoever knows whether it is there."""

    def __init__(self):
        self.states, self.depths, self.closings = [0, 1], [0, 0], [{}, {}]
        self.pending, self.broken, self.first, self.octets = False, False, None, 0

    def add(self, text: str, octets: int):
        if self.pending:
            self.close()
        if self.first is None:
            self.first = text.removeprefix(_ORDER_MARK).lstrip(_BLANK)[:1]
        scan = Scan(text)
        self.broken |= scan.broken
        for s in (0, 1):
            self.depths[s] += scan.changes[self.states[s]]
            self.states[s] ^= scan.swaps
        self.octets += octets + 1
        self.pending = True

    def close(self):
        for s in (0, 1):
            if not self.states[s]:
                self.depths[s] -= 1
                counts = self.closings[s]
                counts[self.depths[s]] = counts.get(self.depths[s], 0) + 1


def _check(value: str):
    """Is the text a JSON object? None, or the problem."""
    try:
        return None if isinstance(json.loads(value), dict) else "neither list nor objects"
    except (ValueError, RecursionError):
        return "broken JSON"


class Records:
    """Splits a range into records, from the state in which it starts."""

    def __init__(self, inside, depth, pos, base, at_start):
        self.inside, self.depth, self.pos, self.base = inside, depth, pos, base
        self.held = None if depth <= base and not inside else []
        self.begun_here, self.at_start, self.ended, self.problem = self.held is None, at_start, False, None

    def _between(self, text: str):
        """What stands before a record: checks it, and returns the rest."""
        rest = (text.removeprefix(_ORDER_MARK) if self.at_start else text).lstrip(_BLANK)
        if self.at_start:
            rest = rest[1:].lstrip(_BLANK) if self.base else rest
        elif self.base and rest.startswith(","):
            rest = rest[1:].lstrip(_BLANK)
        elif self.base and not rest.startswith("]"):
            self.problem = "broken JSON"
        return rest

    def feed(self, text: str, brace: bool):
        """A piece and whether a brace ends it; returns ``(text, starts here)`` of the record that it completes."""
        if self.problem:
            return None
        scan = Scan(text)
        if self.held is None:
            comma = text.lstrip(_BLANK)[:1] == ","
            rest = self._between(text)
            if self.base and not self.problem and rest[:1] == "]" and not comma:
                self.depth -= 1
                if rest[1:].strip(_BLANK) or brace or self.ended:
                    self.problem = "text after the list"
                self.ended, self.at_start = True, False
                return None
            if not rest and not brace and (not self.base or self.at_start):
                self.at_start = False
                return None
            if self.problem or self.ended or not rest.startswith("{"):
                self.problem = self.problem or ("text after the list" if self.ended else _other(rest, self.base))
                return None
            self.held, self.begun_here, self.at_start, text = [], True, False, rest
            self.depth = self.base
            scan = Scan(text)
        self.depth += scan.changes[self.inside]
        self.inside ^= scan.swaps
        self.held.append(text + "}" * brace)
        if brace and not self.inside:
            self.depth -= 1
            if self.depth == self.base:
                value, here = "".join(self.held), self.begun_here
                self.held, self.pos = None, self.pos + 1
                return value, here
        return None


def _other(rest: str, base: int) -> str:
    """What is wrong with text where an object should begin."""
    try:
        json.JSONDecoder().raw_decode(rest)
    except (ValueError, RecursionError):
        return "broken JSON"
    return "a list of other things than objects" if base else "neither list nor objects"


# ---- the passes

def _pieces(spark: SparkSession, paths) -> DataFrame:
    rows = spark.read.option("lineSep", "}").text(paths)
    return rows.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
                       F.col("_metadata.file_size").alias("size"), "value", F.octet_length("value").cast("bigint").alias("octets"))


def _ranges(batches):
    """Runs of rows of one range: ``(path, start, size, rows)`` with the texts and lengths of its next pieces."""
    for batch in batches:
        keys = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
        texts, octets, at = batch.column(3).to_pylist(), batch.column(4).to_pylist(), 0
        while at < len(keys):
            to = at + 1
            while to < len(keys) and keys[to] == keys[at]:
                to += 1
            yield keys[at], list(zip(texts[at:to], octets[at:to]))
            at = to


def summaries(pieces: DataFrame) -> DataFrame:
    """A row for each range: what it does to a state that is not known yet."""
    schema = pa.schema([("path", pa.string()), ("start", pa.int64()), ("size", pa.int64()), ("octets", pa.int64()), ("first", pa.string()),
                        ("broken", pa.bool_()), ("ends", pa.list_(pa.int32())), ("changes", pa.list_(pa.int64())),
                        ("closings", pa.list_(pa.map_(pa.int64(), pa.int64())))])

    def run(batches):
        here, summary = None, None

        def row():
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(
                (*here, summary.octets, summary.first, summary.broken, summary.states, summary.depths,
                 [list(c.items()) for c in summary.closings]), schema)], schema=schema)
        for key, rows in _ranges(batches):
            if key != here:
                if here is not None:
                    yield row()
                here, summary = key, Summary()
            for text, octets in rows:
                summary.add(text, octets)
        if here is not None:
            yield row()

    return pieces.mapInArrow(run, _SUMMARY)


def compose(rows: list) -> list:
    """The starts of a file's ranges, from their summaries in order."""
    base, problem = int(rows[0]["first"] == "["), None
    # A reader that drops a byte order mark leaves three bytes less; a last piece without a brace counts one too many.
    missing = rows[0]["size"] - sum(r["octets"] for r in rows)
    brace = missing in (0, 3)
    if missing not in (-1, 0, 2, 3) or any(r["broken"] for r in rows):
        problem = "broken JSON"
    inside, depth, pos, out = 0, 0, 0, []
    for k, r in enumerate(rows):
        last = k == len(rows) - 1
        out.append({"path": r["path"], "start": r["start"], "inside": bool(inside), "depth": depth, "pos": pos, "base": base,
                    "last": last, "brace": brace or not last, "problem": None})
        pos += dict(r["closings"][inside]).get(base - depth, 0)
        depth, inside = depth + r["changes"][inside], r["ends"][inside]
        if (brace or not last) and not inside:
            depth -= 1
            pos += depth == base
    if inside or depth:
        problem = problem or "broken JSON"
    for row in out:
        row["problem"] = problem
    return out


def range_starts(found: DataFrame) -> DataFrame:
    """In which state, at which depth and record each range starts; a file has few ranges, which are one group."""
    names = ["path", "start", "inside", "depth", "pos", "base", "last", "brace", "problem"]
    types = [pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.string()]

    def run(table):
        rows = compose(sorted(table.to_pylist(), key=lambda r: r["start"]))
        return pa.table([pa.array([r[n] for r in rows], t) for n, t in zip(names, types)], names)

    return found.groupBy("path").applyInArrow(run, _STARTS)


def split_records(pieces: DataFrame, starts: list) -> DataFrame:
    """Records, parts of records that cross ranges, and problems of the ranges whose ``starts`` are given."""
    known = {(s.path, s.start): s for s in starts}
    schema = pa.schema([("path", pa.string()), ("pos", pa.int64()), ("start", pa.int64()), ("value", pa.string()), ("part", pa.bool_()),
                        ("problem", pa.string())])

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def run(batches):
        here, records, waiting, out, size = None, None, None, [], 0

        def take(text, brace):
            nonlocal size
            done = records.feed(text, brace)
            if records.problem and records.problem != "told":
                out.append((here.path, None, here.start, None, False, records.problem))
                records.problem = "told"
            elif done:
                value, whole = done
                problem = _check(value) if whole else None
                out.append((here.path, records.pos - 1, here.start, None if problem else value, not whole, problem))
                size += len(value)

        def end():
            """The last piece of a range, and the part of a record that goes on in the next."""
            if here is None:
                return
            take(waiting, here.brace)
            if records.held and not records.problem:
                out.append((here.path, records.pos, here.start, "".join(records.held), True, None))
        for key, rows in _ranges(batches):
            start = known.get(key[:2])
            if start is None:
                continue
            if here is None or (here.path, here.start) != key[:2]:
                end()
                here, waiting = start, None
                records = Records(int(start.inside), start.depth, start.pos, start.base, start.start == 0)
            for text, _ in rows:
                if waiting is not None:
                    take(waiting, True)
                waiting = text
                if size >= 8 << 20 or len(out) >= 10_000:
                    yield batch_of(out)
                    out, size = [], 0
        end()
        if out:
            yield batch_of(out)

    return pieces.mapInArrow(run, _RECORDS)


def _checked(values: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            problems = [_check(v) for v in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(problems, pa.string())],
                                             ["path", "pos", "value", "problem"])
    return values.select("path", "pos", "value").mapInArrow(run, "path string, pos bigint, value string, problem string")


def read_records(spark: SparkSession, paths):
    """``records(path, pos, value)``: the objects of JSON files as texts, with their place; and ``rejects(path, problem)``.

    A file holds one list of objects, or objects one after the other; anything else is a reject and gives no records.
    Every file is read by ranges of ``spark.sql.files.maxPartitionBytes``, twice; one record has to fit a task. Files must
    not be compressed. A file without any text gives neither records nor a reject.
    """
    pieces = _pieces(spark, paths)
    starts = staged(range_starts(staged(summaries(pieces), "ranges")), "starts")
    found = None
    # Of a range its start alone passes the driver, for a bounded number of ranges at once; files without problem so far.
    batch, batches = [], []
    for row in starts.filter(F.col("problem").isNull()).orderBy("path", "start").toLocalIterator():
        if len(batch) >= _RANGES_AT_ONCE and row.start == 0:
            batches.append(batch)
            batch = []
        batch.append(row)
    for batch in [*batches, batch] if batch else batches:
        some = split_records(pieces.filter(F.col("path").between(batch[0].path, batch[-1].path)), batch)
        found = some if found is None else found.unionByName(some)
    if found is None:
        found = spark.createDataFrame([], _RECORDS)
    found = staged(found, "records")
    joined = found.filter("part").groupBy("path", "pos").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("start", "value"))), lambda p: p["value"]), "").alias("value"))
    crossing = staged(_checked(joined), "crossing")
    problems = starts.filter(F.col("problem").isNotNull()).select("path", "problem") \
        .unionByName(found.filter(F.col("problem").isNotNull()).select("path", "problem")) \
        .unionByName(crossing.filter(F.col("problem").isNotNull()).select("path", "problem"))
    rejects = staged(problems.groupBy("path").agg(F.min("problem").alias("problem")), "rejects")
    whole = found.filter(~F.col("part") & F.col("problem").isNull()).select("path", "pos", "value").unionByName(
        crossing.select("path", "pos", "value"))
    return whole.join(rejects, "path", "left_anti"), rejects
