"""Token counts without token ids: pieces once per distinct pre-token, times how often a document has it.

Documents are taken in groups of some megabytes. A group keeps its distinct pre-tokens, in parts by a checksum, and for
each document how often it has which of them. All groups' pre-tokens of a part come together, where each distinct one
is counted once; the counts go back to the groups as a few bytes each, and a document's tokens are a sum of products. So
a pre-token is shuffled once for a group, not for a document, and one that all groups have is no larger than others.
"""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslake.llm.common import read_file, worker_state
from newslake.session import staged

_MARK = "▁"  # what the model writes for a space
_PRE_TOKEN = re.compile(" +[^ ]*")
_CUT = re.compile("(?<! ) ")


class PieceCounter:
    """Pieces of a pre-token: one or more spaces and what follows up to the next space.

    No piece of the vocabulary has a space after another character, which is checked here, so no piece spans two
    pre-tokens and their counts add up. The model puts a space before each text, so a pre-token loses its first.
    """

    def __init__(self, data: bytes):
        import sentencepiece

        self.model = model = sentencepiece.SentencePieceProcessor(model_proto=data)
        pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
        if any(_MARK in p.lstrip(_MARK) for p in pieces) or model.encode_as_pieces("a  b") != [_MARK + "a", _MARK, _MARK + "b"] \
                and "".join(model.encode_as_pieces("a  b")) != _MARK + "a" + 2 * _MARK + "b":
            raise ValueError("this model's pieces do not end at spaces")

    def counts(self, rests: list) -> list:
        """Pieces of pre-tokens, given without their first space."""
        return [len(p) if rest else 1 for rest, p in zip(rests, self.model.encode(rests, out_type=str, num_threads=1))]

    @staticmethod
    def pre_tokens(text: str, size: int = 1 << 18):
        """The pre-tokens of a text without their first space, in lists for slices of the text."""
        if not text:
            return
        body, start = " " + text.replace(_MARK, " "), 0
        while start < len(body):
            cut = _CUT.search(body, start + size) if len(body) - start > size else None
            end = cut.start() if cut else len(body)
            part = body[start:end]
            yield [m[1:] for m in _PRE_TOKEN.findall(part)] if "  " in part else part[1:].split(" ")
            start = end

    def tokens(self, text: str) -> int:
        """Of one text, for trying out a model."""
        group = Group()
        group.add(None, 0, text)
        parts, sizes, steps, times = group.packed(3)
        counts = np.concatenate([np.array(self.counts(unpacked(*p[1:])), np.int64) for p in parts if p[0]] or [np.empty(0, np.int64)])
        return int(sums_of(sizes, steps, times, counts)[0])


def narrow(numbers: np.ndarray) -> bytes:
    """Numbers in one, two or four bytes each, as the largest needs, compressed; ``wide`` reads them, given how many there are."""
    top = int(numbers.max(initial=0))
    return pressed(numbers.astype("<u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4").tobytes())


def pressed(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def whole(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def wide(data: bytes, n: int) -> np.ndarray:
    if not n:
        return np.empty(0, np.int64)
    data = whole(data)
    return np.frombuffer(data, f"<u{len(data) // n}").astype(np.int64)


def unpacked(lengths: bytes, data: bytes) -> list:
    """The pre-tokens of a part."""
    ends, data = np.cumsum(np.frombuffer(whole(lengths), "<u4"), dtype=np.int64).tolist(), whole(data)
    return [data[a:b].decode() for a, b in zip([0, *ends], ends)]


class Group:
    """Documents with the frequencies of their pre-tokens, which the group numbers."""

    def __init__(self):
        self.numbers = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.ids, self.n_bytes, self.places, self.times = [], [], [], []
        self.held = 0

    def add(self, doc_id, n_bytes: int, text: str) -> None:
        number, parts = self.numbers.__getitem__, []
        for part in PieceCounter.pre_tokens(text):
            parts.append(np.fromiter(map(number, part), np.int32, len(part)))
        places, times = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.empty(0, np.int32),) * 2
        self.ids.append(doc_id)
        self.n_bytes.append(n_bytes)
        self.places.append(places)
        self.times.append(times)
        self.held += len(text)

    def packed(self, n_parts: int):
        """The parts ``(n, lengths, data)`` of pre-tokens, which are numbered in their order, and of all documents one after the
        other how many they have, the steps from one number to the next, and how often they have it."""
        tokens = [t.encode() for t in self.numbers]
        part = np.fromiter((zlib.crc32(t) % n_parts for t in tokens), np.int64, len(tokens))
        order = np.argsort(part, kind="stable")
        number = np.empty(len(tokens), np.int64)
        number[order] = np.arange(len(tokens))
        parts = []
        for chosen in np.split(order, np.cumsum(np.bincount(part, minlength=n_parts))[:-1]):
            some = [tokens[k] for k in chosen.tolist()]
            parts.append((len(some), pressed(np.fromiter(map(len, some), "<u4", len(some)).tobytes()), pressed(b"".join(some))))
        steps, times = [], []
        for places, often in zip(self.places, self.times):
            found = number[places]
            by_number = np.argsort(found)
            steps.append(np.diff(found[by_number], prepend=0))
            times.append(often[by_number])
        sizes = np.fromiter(map(len, steps), np.int64, len(steps))
        return parts, sizes, np.concatenate(steps), np.concatenate(times)


def sums_of(sizes, steps, times, counts) -> np.ndarray:
    """For each document its frequencies times the counts of its pre-tokens."""
    stops = np.cumsum(sizes)
    starts = stops - sizes
    run = np.concatenate([[0], np.cumsum(steps)])
    # Steps begin anew with each document.
    places = run[1:] - np.repeat(run[starts], sizes)
    ends = np.concatenate([[0], np.cumsum(counts[places] * times)])
    return ends[stops] - ends[starts]


def frequency_groups(docs: DataFrame, id_col: str, text_col: str, group: int, n_parts: int) -> DataFrame:
    """One row for each group of documents, as a stored table: ids, bytes, parts of pre-tokens, and frequencies."""
    part = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("lengths", T.BinaryType()), T.StructField("data", T.BinaryType())])
    schema = T.StructType([
        T.StructField("group", T.LongType()), T.StructField("ids", T.ArrayType(docs.schema[id_col].dataType)),
        T.StructField("n_bytes", T.ArrayType(T.LongType())), T.StructField("parts", T.ArrayType(part)),
        T.StructField("n", T.LongType()), *(T.StructField(n, T.BinaryType()) for n in ("sizes", "steps", "times"))])
    part_type = pa.list_(pa.struct([("part", pa.int32()), ("n", pa.int64()), ("lengths", pa.binary()), ("data", pa.binary())]))

    def run(batches):
        number = TaskContext.get().partitionId() << 32

        def row():
            parts, sizes, steps, times = held.packed(n_parts)
            parts = [{"part": k, "n": n, "lengths": a, "data": b} for k, (n, a, b) in enumerate(parts) if n]
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([held.ids], pa.list_(kind)), pa.array([held.n_bytes], pa.list_(pa.int64())),
                 pa.array([parts], part_type), pa.array([len(steps)], pa.int64()),
                 *(pa.array([narrow(a)], pa.binary()) for a in (sizes, steps, times))],
                ["group", "ids", "n_bytes", "parts", "n", "sizes", "steps", "times"])

        held, kind = Group(), None
        for batch in batches:
            kind = batch.schema.types[0]
            for doc_id, text, n_bytes in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                held.add(doc_id, n_bytes, text.as_py() or "")
                if held.held >= group or len(held.ids) >= 100_000:
                    yield row()
                    held, number = Group(), number + 1
        if held.ids:
            yield row()

    n_bytes = F.coalesce(F.octet_length(F.col(text_col)).cast("bigint"), F.lit(0).cast("bigint"))
    return staged(docs.select(F.col(id_col), F.col(text_col), n_bytes).mapInArrow(run, schema), "frequencies")


def piece_counts(parts: DataFrame, data: bytes, n_parts: int) -> DataFrame:
    """``of, part, counts``: the pieces of each pre-token of ``parts(of, part, n, lengths, data)``.

    All rows of a part come to one task, which asks the model for each distinct pre-token once.
    """
    key = ("pieces", hashlib.md5(data).hexdigest())

    def run(batches):
        counter, known = worker_state(key, lambda: PieceCounter(data)), {}
        for batch in batches:
            counts = []
            for lengths, joined in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                tokens = unpacked(lengths, joined)
                new = list(set(tokens).difference(known))
                known.update(zip(new, counter.counts(new) if new else ()))
                counts.append(narrow(np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens))))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(counts, pa.binary())], ["of", "part", "n", "counts"])

    return parts.repartition(n_parts, "part").mapInArrow(run, "of bigint, part int, n bigint, counts binary")


def count_tokens(docs: DataFrame, model: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text",
                 group: int = 32 << 20, n_parts: int | None = None) -> DataFrame:
    """Tokens of each text as the sentencepiece model gives them, without begin or end tokens.

    Columns: the id column, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` (more than ``limit`` tokens).
    A null text counts as empty: zero bytes and tokens. Repeated rows are repeated, an empty table gives an empty
    table, other columns of any name are not read, long texts are taken in slices. A group ends at ``group`` characters;
    the document that ends it, and a group's pre-tokens, are what a task holds. The distinct pre-tokens of a part are held
    by the task that counts them; there are ``n_parts`` parts, by default as many as shuffle partitions.
    """
    data, spark = read_file(model), docs.sparkSession
    n_parts = n_parts or max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    groups = frequency_groups(docs, id_col, text_col, group, n_parts)
    parts = groups.select(F.col("group").alias("of"), F.inline("parts"))
    counts = piece_counts(parts, data, n_parts)
    kind = docs.schema[id_col].dataType
    names = [id_col, "n_bytes", "n_tokens"]
    schema = T.StructType([T.StructField(id_col, kind), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def run(left, right):
        found = sorted(zip(right["part"].to_pylist(), right["n"].to_pylist(), right["counts"].to_pylist()))
        counts = np.concatenate([np.empty(0, np.int64), *(wide(c, n) for _, n, c in found)])
        row = left.to_batches()[0]
        ids, n_bytes = (row.column(row.schema.get_field_index(c)).slice(0, 1).flatten() for c in ("ids", "n_bytes"))
        n, sizes, steps, times = (left[c][0].as_py() for c in ("n", "sizes", "steps", "times"))
        sums = sums_of(wide(sizes, len(ids)), wide(steps, n), wide(times, n), counts)
        return pa.table([ids, n_bytes, pa.array(sums, pa.int64())], names)

    summed = groups.drop("parts").groupBy("group").cogroup(counts.groupBy("of")).applyInArrow(run, schema)
    return summed.withColumn("over_limit", F.col("n_tokens") > limit)
