"""Exact de-duplication as a Grace hash: spill by hash until a bucket fits a table that compares whole contents.

It runs twice. First each task reduces its own rows to one record for each distinct content, so a text that makes up a
third of the corpus leaves a task once. Then those records meet by hash, and only there is content shuffled. A row's
answer comes back over the number of its task's record, so that join is spread over the tasks, too.
"""

import hashlib
import os
import pickle
import shutil
import tempfile

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.llm.common import WHITE, unused
from newslake.session import staged

_WHITE = WHITE.encode()
FAN_OUT = 16


def normalised(text: str) -> bytes:
    return text.encode().translate(None, _WHITE)


# What an entry takes besides its content: slots, hash, object heads, places in lists, the value.
_ENTRY = 450


class ContentTable:
    """Open addressing with linear probing; a slot is a place in the lists of hashes and contents. ``size`` is in bytes."""

    def __init__(self):
        self.slots, self.hashes, self.contents, self.values, self.size = [-1] * 1024, [], [], [], 0

    def find(self, h: int, content: bytes, value):
        """The value kept for this content; ``value`` is kept if it is new."""
        slots = self.slots
        mask = len(slots) - 1
        i = h & mask
        while (place := slots[i]) >= 0:
            if self.hashes[place] == h and self.contents[place] == content:
                return self.values[place]
            i = (i + 1) & mask
        slots[i] = len(self.values)
        self.hashes.append(h)
        self.contents.append(content)
        self.values.append(value)
        self.size += len(content) + _ENTRY
        if 2 * len(self.values) > len(slots):
            self._grow()
        return value

    def _grow(self):
        mask = 2 * len(self.slots) - 1
        self.slots = slots = [-1] * (mask + 1)
        for place, h in enumerate(self.hashes):
            i = h & mask
            while slots[i] >= 0:
                i = (i + 1) & mask
            slots[i] = place


def grace(records, add, memory: int, level: int = 0, pause: int = 0):
    """Tables that between them hold every distinct content of ``records``, one at a time.

    ``records`` are ``(hash, content, payload)``. Those that fit ``memory`` bytes go to one table; else what is
    there already stays, and all other contents go to ``FAN_OUT`` spill files by the next bits of their hash, each of
    which is treated alike. A content that a table holds needs no spilling, so copies cost nothing.
    ``add(value, payload)`` gives the value of a content, at first with ``None``. With ``pause`` there is a ``None`` after so
    many records, for callers that hand on what they have gathered.
    """
    table, folder, files = ContentTable(), None, []
    shift = 60 - 4 * level
    try:
        for count, (h, content, payload) in enumerate(records, 1):
            if pause and count % pause == 0:
                yield None
            if table.size < memory or shift < 0:
                slot = table.find(h, content, [None])
            else:
                slot = _held(table, h, content)
            if slot is not None:
                slot[0] = add(slot[0], payload)
                continue
            if folder is None:
                folder = tempfile.mkdtemp(prefix="grace-")
                files = [open(os.path.join(folder, str(k)), "wb") for k in range(FAN_OUT)]
            pickle.dump((h, content, payload), files[h >> shift & FAN_OUT - 1], pickle.HIGHEST_PROTOCOL)
        yield table
        del table
        for file in files:
            file.close()
        for file in files:
            if os.path.getsize(file.name):
                yield from grace(_read(file.name), add, memory, level + 1, pause)
            os.unlink(file.name)
    finally:
        for file in files:
            file.close()
        if folder is not None:
            shutil.rmtree(folder, ignore_errors=True)


def _held(table, h, content):
    mask = len(table.slots) - 1
    i = h & mask
    while (place := table.slots[i]) >= 0:
        if table.hashes[place] == h and table.contents[place] == content:
            return table.values[place]
        i = (i + 1) & mask
    return None


def _read(path):
    with open(path, "rb") as file:
        load = pickle.Unpickler(file).load
        while True:
            try:
                yield load()
            except EOFError:
                return


def _better(a, b):
    """The longer original, then the smaller id, then the lower number; a null id comes after all others."""
    return b if (-b[0], b[1] is None, b[1] or 0, b[2]) < (-a[0], a[1] is None, a[1] or 0, a[2]) else a


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


_OUT, _OUT_BYTES = 2_000, 8 << 20


def _local(memory):
    """Rows of one task to records, and members that point to them; members are handed on as they come."""
    def run(batches):
        task, numbers, out = TaskContext.get().partitionId() << 40, iter(range(1 << 40)), []

        def records():
            for batch in batches:
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    text = text.as_py() or ""
                    content = normalised(text)
                    yield xxhash.xxh3_64_intdigest(content), content, (len(text), doc_id)

        def add(value, payload):
            number, best, n = value or (task | next(numbers), None, 0)
            out.append((number, None, None, None, None, None, payload[1], n))
            mine = (*payload, number, n)
            return number, _better(best, mine) if best else mine, n + 1

        for table in grace(records(), add, memory, pause=_OUT):
            yield out[:]
            out.clear()
            rows, size = [], 0
            for h, content, (value,) in zip(table.hashes, table.contents, table.values) if table else ():
                number, (chars, best, _, place), n = value
                rows.append((number, _signed(h), content, chars, best, n, None, place))
                size += len(content)
                if len(rows) >= _OUT or size >= _OUT_BYTES:
                    yield rows
                    rows, size = [], 0
            yield rows
    return run


def _meet(memory):
    """Records with equal content get one answer; ``place`` is that of the row that stays, where it is in this record."""
    def run(batches):
        def records():
            for batch in batches:
                for number, h, content, chars, best, count, place in zip(*(c.to_pylist() for c in batch.columns)):
                    yield h & (1 << 64) - 1, content, (count, (chars, best, number, place))

        def add(value, payload):
            count, best = payload
            total, top, numbers = value or (0, best, [])
            numbers.append(best[2])
            return total + count, _better(top, best), numbers

        for table in grace(records(), add, memory):
            rows = []
            for content, (value,) in zip(table.contents, table.values):
                total, (_, keep, winner, place), numbers = value
                digest = hashlib.sha256(content).hexdigest()
                rows += [(number, keep, total, place if number == winner else None, digest) for number in numbers]
                if len(rows) >= _OUT:
                    yield rows
                    rows = []
            yield rows
    return run


def _batches(run, schema):
    def wrapped(batches):
        for rows in run(batches):
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
    return wrapped


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     memory: int = 48 << 20) -> DataFrame:
    """For each row, which row of those with the same text stays.

    Texts are the same if they are equal without ASCII white space. The row with the most code points in its original
    text stays, of these the one with the smallest id; a null id comes after all others. Columns: the id column,
    ``keep_id``, ``group_size``, ``kept``, ``text_sha256``. A null text counts as empty, and empty texts are copies of
    each other. Of rows that repeat both id and text, one is kept. An empty table gives an empty table; other columns
    of any name are not read; ids must be integers. ``memory`` bounds the bytes that a task's table takes, content and
    all; beyond it, it spills. Members of a group, however many, are handed on and not gathered.
    """
    schema = pa.schema([("number", pa.int64()), ("h", pa.int64()), ("content", pa.binary()), ("chars", pa.int64()),
                        ("best", pa.int64()), ("n", pa.int64()), ("member", pa.int64()), ("place", pa.int64())])
    rows = staged(docs.select(F.col(id_col).cast("bigint"), F.col(text_col)).mapInArrow(
        _batches(_local(memory), schema), "number bigint, h bigint, content binary, chars bigint, best bigint, n bigint, "
        "member bigint, place bigint"), "exact")
    answer = pa.schema([("number", pa.int64()), ("keep_id", pa.int64()), ("group_size", pa.int64()), ("winner", pa.int64()),
                        ("text_sha256", pa.string())])
    records = rows.filter(F.col("h").isNotNull()).select("number", "h", "content", "chars", "best", "n", "place")
    met = records.repartition("h").mapInArrow(_batches(_meet(memory), answer),
                                              "number bigint, keep_id bigint, group_size bigint, winner bigint, text_sha256 string")
    members = rows.filter(F.col("h").isNull()).select("number", "member", "place")
    return members.join(met, "number").select(
        F.col("member").alias(id_col), "keep_id", "group_size", F.coalesce(F.col("place") == F.col("winner"), F.lit(False)).alias("kept"),
        "text_sha256")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", memory: int = 48 << 20) -> DataFrame:
    """The rows that stay, with all their columns; ids need not be unique.

    Rows are found again by id and content. Only where a row that stays is repeated, with its id, one is picked.
    """
    answer = exact_duplicates(docs, id_col, text_col, memory)
    key, digest, copies = unused(docs, "key", "digest", "copies")
    stays = answer.filter(F.col(id_col).eqNullSafe(F.col("keep_id"))).groupBy(
        F.col(id_col).alias(key), F.col("text_sha256").alias(digest)).agg(F.count("*").alias(copies))
    sha = F.sha2(F.translate(F.coalesce(F.col(text_col), F.lit("")), WHITE, ""), 256)
    found = docs.join(stays, F.col(id_col).eqNullSafe(F.col(key)) & (sha == F.col(digest)))
    repeated = found.filter(F.col(copies) > 1).dropDuplicates([key, digest])
    return found.filter(F.col(copies) == 1).unionByName(repeated).select(*docs.columns)
