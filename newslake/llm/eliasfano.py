"""Token ids in binary files whose document boundaries are Elias-Fano coded.

    ids         all ids of the file one after the other, two bytes each where the vocabulary allows, else four
    bounds      Elias-Fano list of the places where documents start, and the end
    documents   Elias-Fano list of document ids less the smallest, which is in the footer
    footer      JSON: counts, widths, place and length of each part; its length in four bytes; eight bytes of mark

A list of ``n`` rising numbers below ``u`` is kept as ``l = log2(u / n)`` low bits each, packed, and the high parts as
one bit string: number ``i`` sets bit ``high + i``. Its ``i``-th set bit therefore gives the high part back (select).
The place of every 512th set bit is kept in 32 bits; from there whole words are counted. That is about ``2 + l`` bits
a document, where a table of places would take 64.
"""

import hashlib
import json
import os
import re
import struct
import uuid
import zlib
from array import array
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake.llm.archive import open_store
from newslake.llm.bpe import _SPACE
from newslake.llm.common import Memo, read_file, worker_state
from newslake.session import scratch_path

_MARK = b"EFTOKEN1"
_SAMPLE = 512
# Of ASCII: white space, signs, letters and digits; all else is 0.
_KINDS = np.array([1 if c == 32 or 9 <= c <= 13 else 3 if c < 128 and chr(c).isalnum() else 2 if 32 < c < 127 else 0 for c in range(256)], np.uint8)


# ---- rising numbers

class EliasFano:
    """A list of numbers that never fall, as low bits, a bit string of high parts, and places in it."""

    def __init__(self, n, low_bits, low, high, samples):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def build(cls, values) -> "EliasFano":
        values = np.asarray(values, np.uint64)
        n = len(values)
        if n and (values[1:] < values[:-1]).any():
            raise ValueError("the numbers must not fall")
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        ones = (values >> np.uint64(low_bits)) + np.arange(n, dtype=np.uint64)
        size = int(ones[-1]) + 1 if n else 0
        if size >= 1 << 32:
            raise ValueError("too many numbers for 32-bit places")
        bits = np.zeros(size, np.uint8)
        bits[ones] = 1
        return cls(n, low_bits, _pack_low(values, low_bits), _words(np.packbits(bits, bitorder="little")),
                   ones[::_SAMPLE].astype("<u4"))

    def parts(self) -> list:
        return [self.low.tobytes(), self.high.tobytes(), self.samples.tobytes()]

    @classmethod
    def of(cls, n, low_bits, parts) -> "EliasFano":
        low, high, samples = parts
        return cls(n, low_bits, np.frombuffer(low, np.uint8), np.frombuffer(high, "<u8"), np.frombuffer(samples, "<u4"))

    def n_bytes(self) -> int:
        return sum(map(len, self.parts()))

    def select(self, i: int) -> int:
        """The place of set bit ``i``: on from the last place kept, word by word."""
        place = int(self.samples[i // _SAMPLE])
        left, word = i % _SAMPLE, place >> 6
        rest = int(self.high[word]) >> (place & 63) << (place & 63)
        while left >= rest.bit_count():
            left -= rest.bit_count()
            word += 1
            rest = int(self.high[word])
        for _ in range(left):
            rest &= rest - 1
        return (word << 6) + (rest & -rest).bit_length() - 1

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        return (self.select(i) - i) << self.low_bits | int(_unpack_low(self.low, self.low_bits, i, i + 1)[0])

    def slice(self, start: int, stop: int) -> np.ndarray:
        """Numbers ``start`` to ``stop`` at once."""
        if start >= stop:
            return np.empty(0, np.uint64)
        first = self.select(start)
        last = self.select(stop - 1)
        words = self.high[first >> 6:(last >> 6) + 1]
        bits = np.unpackbits(words.view(np.uint8), bitorder="little")
        ones = np.flatnonzero(bits).astype(np.uint64) + np.uint64(first >> 6 << 6)
        ones = ones[ones >= first][:stop - start]
        high = ones - np.arange(start, stop, dtype=np.uint64)
        return high << np.uint64(self.low_bits) | _unpack_low(self.low, self.low_bits, start, stop)


def _words(data: np.ndarray) -> np.ndarray:
    return np.concatenate([data, np.zeros(-len(data) % 8, np.uint8)]).view("<u8")


def _pack_low(values, bits, step=1 << 16) -> np.ndarray:
    # A step's bits are whole bytes, so the parts join without shifts.
    shifts, out = np.arange(bits, dtype=np.uint64), [np.empty(0, np.uint8)]
    for at in range(0, len(values) if bits else 0, step):
        out.append(np.packbits((values[at:at + step, None] >> shifts & np.uint64(1)).astype(np.uint8), bitorder="little"))
    return np.concatenate(out)


def _unpack_low(low, bits, start, stop) -> np.ndarray:
    if not bits:
        return np.zeros(stop - start, np.uint64)
    first = start * bits
    data = np.unpackbits(low[first >> 3:(stop * bits + 7) >> 3], bitorder="little")
    data = data[first & 7:(first & 7) + (stop - start) * bits].reshape(-1, bits).astype(np.uint64)
    return (data << np.arange(bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


# ---- files

class IdWriter:
    """Ids of documents, in ascending order of their document ids (null first), to a stream."""

    def __init__(self, sink, width: int):
        self.sink, self.width, self.at = sink, width, 0
        self.bounds, self.documents, self.nulls = array("Q", [0]), array("q"), 0

    def add(self, doc_id, blocks) -> None:
        for block in blocks:
            self.sink.write(block)
            self.at += len(block)
        self.bounds.append(self.at // self.width)
        if doc_id is None:
            self.nulls += 1
        else:
            self.documents.append(doc_id)

    def full(self, ids: int, documents: int) -> bool:
        return self.bounds[-1] >= ids or len(self.bounds) > documents

    def close(self) -> tuple:
        """Write lists and footer; returns the numbers of documents and ids."""
        bounds = EliasFano.build(self.bounds)
        documents = np.array(self.documents, np.int64).view(np.uint64)
        smallest = self.documents[0] if len(documents) else 0
        documents = EliasFano.build(documents - np.uint64(smallest & (1 << 64) - 1))
        footer = {"documents": len(self.bounds) - 1, "null_documents": self.nulls, "smallest": smallest, "ids": self.bounds[-1],
                  "width": self.width, "low_bits": [bounds.low_bits, documents.low_bits], "parts": []}
        for part in bounds.parts() + documents.parts():
            footer["parts"].append([self.at, len(part)])
            self.sink.write(part)
            self.at += len(part)
        footer = json.dumps(footer).encode()
        self.sink.write(footer + struct.pack("<I", len(footer)) + _MARK)
        return len(self.bounds) - 1, self.bounds[-1]


class IdFile:
    """Random access to a file of ids; ``file`` gives ``size()`` and ``read_at(n, offset)``."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        tail = file.read_at(min(size, 4096), max(0, size - 4096))
        if tail[-8:] != _MARK:
            raise ValueError("not a file of token ids, or not whole")
        length, = struct.unpack("<I", tail[-12:-8])
        if length + 12 > len(tail):
            tail = file.read_at(length + 12, size - length - 12)
        self.footer = footer = json.loads(tail[-12 - length:-12])
        parts = [file.read_at(n, at) if n else b"" for at, n in footer["parts"]]
        self.n, self.width, self.nulls = footer["documents"], footer["width"], footer["null_documents"]
        self.bounds = EliasFano.of(self.n + 1, footer["low_bits"][0], parts[:3])
        self.documents = EliasFano.of(self.n - self.nulls, footer["low_bits"][1], parts[3:])

    def doc_ids(self, start: int, stop: int) -> list:
        known = self.documents.slice(max(0, start - self.nulls), max(0, stop - self.nulls))
        known = (known + np.uint64(self.footer["smallest"] & (1 << 64) - 1)).view(np.int64).tolist()
        return [None] * (stop - start - len(known)) + known

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the file, as 32-bit numbers."""
        data = self.file.read_at((stop - start) * self.width, start * self.width) if stop > start else b""
        return np.frombuffer(data, f"<u{self.width}").astype("<u4")

    def document(self, i: int) -> np.ndarray:
        return self.ids(self.bounds[i], self.bounds[i + 1])

    def spans(self, start: int, stop: int, most: int = 1 << 20):
        """For each document from ``start`` to ``stop`` its place, length, and its ids in blocks of ``most`` at most."""
        bounds = self.bounds.slice(start, stop + 1).astype(np.int64)
        lengths = np.diff(bounds).tolist()
        places = bounds.tolist()
        held, held_from, held_to = np.empty(0, "<u4"), 0, 0
        for k, (place, length) in enumerate(zip(places, lengths)):
            if length > most:
                yield place, length, (self.ids(at, min(at + most, place + length)) for at in range(place, place + length, most))
                continue
            if place + length > held_to:
                # As many whole documents as fit; the next read starts with one that did not.
                held_from = place
                held_to = places[max(k + 1, int(np.searchsorted(bounds, place + most, "right")) - 1)]
                held = self.ids(held_from, held_to)
            yield place, length, [held[place - held_from:place - held_from + length]]


# ---- texts

class TextIds:
    """A text's ids as the tokenizers library gives them.

    Byte-level vocabularies cut texts before white space that follows something else, and before a sign that follows a
    letter or digit, whatever comes after, so the runs between are independent, and each distinct one is asked for once
    (``memo`` entries in two generations at most). Texts are cut as UTF-8, many at once, before ASCII white space; where
    other white space may stand before it they are not. Other vocabularies, or special strings with white space,
    are given whole texts.
    """

    _CUT = re.compile(f"(?<=[^{_SPACE}])[{_SPACE}]")

    def __init__(self, data: bytes, memo: int):
        from tokenizers import Tokenizer

        spec = json.loads(data)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.library = library = Tokenizer.from_str(data.decode())
        library.no_truncation()
        library.no_padding()
        self.width = 2 if max(library.get_vocab(with_added_tokens=True).values()) < 1 << 16 else 4
        before = spec.get("pre_tokenizer") or {}
        plain = all(not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] or re.search(r"\s", t["content"]))
                    for t in spec["added_tokens"])
        self.by_runs = plain and spec.get("normalizer") is None and before.get("type") == "ByteLevel" \
            and before.get("use_regex") and not before.get("add_prefix_space")
        self.kinds = _KINDS.copy()
        for t in spec["added_tokens"]:
            # Signs that follow a letter or digit within a special string do not end a run.
            self.kinds[[ord(sign) for sign in re.findall(r"(?<=[A-Za-z0-9])[!-/:-@[-`{-~]", t["content"])]] = 0
        # A token of a byte-level vocabulary has a character for each of its bytes.
        sizes = {i: len(token) for token, i in spec["model"]["vocab"].items()} if self.by_runs else {}
        sizes |= {t["id"]: len(t["content"].encode()) for t in spec["added_tokens"]}
        self.sizes = np.zeros(max(sizes, default=0) + 1, np.int64)
        self.sizes[list(sizes)] = list(sizes.values())
        self.known = Memo(lambda run: self.encoded([run.decode()])[0], memo)

    def encoded(self, texts: list) -> list:
        found = [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        data = np.fromiter(chain.from_iterable(found), f"<u{self.width}").tobytes()
        ends = [0, *(self.width * n for n in accumulate(map(len, found)))]
        return [data[a:b] for a, b in zip(ends, ends[1:])]

    def encoded_runs(self, runs: list, size: int = 1 << 15) -> list:
        """The ids of each run. Those that the library cuts off from one another are given to it as texts of about ``size``
        bytes, and their ids parted by the bytes that each id stands for; where these do not add up, one by one."""
        lengths = np.fromiter(map(len, runs), np.int64, len(runs))
        data, ends = np.frombuffer(b"".join(runs), np.uint8), np.cumsum(lengths)
        good = _blank(data[ends - lengths]) & ~_blank(data[ends - 1]) & _cut_after(data, ends)
        if not good.all():
            alone = iter(self.encoded([run.decode() for run, joins in zip(runs, good) if not joins]))
            rest = iter(self.encoded_runs([run for run, joins in zip(runs, good) if joins], size) if good.any() else ())
            return [next(rest if joins else alone) for joins in good.tolist()]
        data = data.tobytes()
        cuts = np.unique([0, *ends[np.searchsorted(ends, np.arange(size, len(data), size))].tolist(), len(data)]).tolist()
        texts = [data[a:b].decode() for a, b in zip(cuts, cuts[1:])]
        ids = np.fromiter(chain.from_iterable(e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)), f"<u{self.width}")
        reached = np.cumsum(self.sizes[ids])
        last = np.searchsorted(reached, ends)
        if not len(ids) or reached[-1] != len(data) or (reached[last] != ends).any():
            return self.encoded([run.decode() for run in runs])
        packed, bounds = ids.tobytes(), [0, *((last + 1) * self.width).tolist()]
        return [packed[a:b] for a, b in zip(bounds, bounds[1:])]

    def blocks(self, text: str, size: int = 1 << 20):
        """The ids of ``text`` in blocks, a slice of the text each."""
        if not self.by_runs:
            yield self.encoded([text])[0]
            return
        start = 0
        while start < len(text):
            cut = self._CUT.search(text, start + size) if len(text) - start > size else None
            end = cut.start() if cut else len(text)
            yield from self._joined([text[start:end]])
            start = end

    def encode(self, texts, size: int = 6 << 20):
        """For each text the blocks of its ids; short ones are worked on together, about ``size`` characters at once."""
        group, held = [], 0
        for text in texts:
            if not self.by_runs or len(text) > size:
                yield from self._single(group)
                group, held = [], 0
                yield self.blocks(text, size)
                continue
            group.append(text)
            held += len(text)
            if held >= size:
                yield from self._single(group)
                group, held = [], 0
        yield from self._single(group)

    def _single(self, group: list):
        return ([ids] for ids in self._joined(group))

    def _joined(self, group: list) -> list:
        """The ids of texts: their runs are told apart at once, and the ids of each distinct one are laid out where it stands."""
        parts = [text.encode() for text in group]
        data, ends = b"".join(parts), np.cumsum([0, *map(len, parts)])
        if not data:
            return [b""] * len(group)
        marked = np.zeros(len(data) + 1, bool)
        marked[_run_starts(np.frombuffer(data, np.uint8), self.kinds)] = marked[ends] = True
        starts = np.flatnonzero(marked)
        runs = pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(starts.astype("<i4")), pa.py_buffer(data)]).dictionary_encode()
        found = self._of_runs(runs.dictionary.to_pylist())
        ids, lengths = np.frombuffer(b"".join(found), f"<u{self.width}"), np.fromiter(map(len, found), np.int64, len(found)) // self.width
        which = runs.indices.to_numpy()
        counts = lengths[which]
        after = np.cumsum(counts)
        # From the place of an id to that of the same id of its run.
        shifts = (np.cumsum(lengths) - lengths)[which] - (after - counts)
        out = ids[np.repeat(shifts, counts) + np.arange(after[-1])]
        bounds = np.concatenate([[0], after])[np.searchsorted(starts, ends)].tolist()
        return [out[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]

    def _of_runs(self, runs: list) -> list:
        """The ids of distinct runs; those not yet known are asked for in one call."""
        known, older = self.known, self.known.older
        found = list(map(known.get, runs))
        missing = [k for k, ids in enumerate(found) if ids is None]
        again = list(map(older.get, [runs[k] for k in missing])) if older else [None] * len(missing)
        asked = [runs[k] for k, ids in zip(missing, again) if ids is None]
        fresh = iter(self.encoded_runs(asked) if asked else ())
        again = [next(fresh) if ids is None else ids for ids in again]
        for k, ids in zip(missing, again):
            found[k] = ids
        known.put_all({runs[k]: ids for k, ids in zip(missing, again) if len(runs[k]) <= 64})
        return found


def _blank(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def _cut_after(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Is what ends before the places ``at`` no white space beyond ASCII? All such is C2 xx, E1 9A xx, E2 80 xx, E2 81 xx or E3 80 xx."""
    return (data[at - 1] < 0x80) | ~np.isin(data[np.maximum(at - 2, 0)], (0xC2, 0x9A, 0x80, 0x81))


def _run_starts(data: np.ndarray, kinds: np.ndarray = _KINDS) -> np.ndarray:
    """Where UTF-8 text may be cut: before ASCII white space that follows neither such nor what may be other white space, and
    before an ASCII sign after an ASCII letter or digit, where a pre-token ends whatever stands around."""
    kind = kinds[data]
    at = np.flatnonzero((kind[1:] == 1) & (kind[:-1] != 1) | (kind[1:] == 2) & (kind[:-1] == 3)) + 1
    return at[_cut_after(data, at)]


# ---- tables

def write_ids(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
              max_ids: int = 64 << 20, max_documents: int = 4 << 20, memo: int = 400_000) -> DataFrame:
    """Write each text's ids and ``end_id`` to files below ``folder``, over all files in ascending order of the ids.

    Returns the table of files, ``folder/files``: ``part, number, path, documents, ids``, in order by part and number.
    Null ids come first, ties of an id are in order of a hash of their text. A null text counts as empty: the end id
    alone. Repeated rows are written as often as they occur, an empty table gives no files, other columns are not read.
    Ids must be integers. A text is encoded in slices; a file ends at ``max_ids`` ids or ``max_documents`` documents, whose
    boundaries are what a task holds. A task names its files when they are whole, so a task that is run again leaves at
    most files that no row names.
    """
    data, spark = read_file(tokenizer), docs.sparkSession
    key = ("text ids", hashlib.md5(data).hexdigest(), memo)

    def run(batches):
        texts = worker_state(key, lambda: TextIds(data, memo))
        end = np.array([end_id], f"<u{texts.width}").tobytes()
        store, root = open_store(folder)
        store.create_dir(root, recursive=True)
        part, number, sink, writer, name = TaskContext.get().partitionId(), 0, None, None, None

        def closed():
            documents, ids = writer.close()
            sink.close()
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int64()), "number": pa.array([number], pa.int64()), "path": [f"{folder}/{name}"],
                "documents": pa.array([documents], pa.int64()), "ids": pa.array([ids], pa.int64())})

        try:
            for batch in batches:
                found = texts.encode(text.as_py() or "" for text in batch.column(1))
                for doc_id, blocks in zip(batch.column(0).to_pylist(), found):
                    if writer is None:
                        name = f"{uuid.uuid4().hex}.ids"
                        sink = store.open_output_stream(f"{root}/{name}")
                        writer = IdWriter(sink, texts.width)
                    writer.add(doc_id, chain(blocks, [end]))
                    if writer.full(max_ids, max_documents):
                        yield closed()
                        number, sink, writer = number + 1, None, None
            if writer is not None:
                yield closed()
                sink = None
        finally:
            if sink is not None:
                sink.close()

    # A repeated id may hold a third of all rows, so ranges are over the id and what tells its rows apart.
    rows = docs.select(F.col(id_col).cast("bigint").alias("key"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("hash"),
                       F.monotonically_increasing_id().alias("row"))
    ordered = rows.repartitionByRange("key", "hash", "row").sortWithinPartitions("key", "hash", "row")
    files = ordered.select("key", "text").mapInArrow(run, "part bigint, number bigint, path string, documents bigint, ids bigint")
    files.write.mode("overwrite").parquet(f"{folder}/files")
    return files_of(spark, folder)


def files_of(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("part bigint, number bigint, path string, documents bigint, ids bigint").parquet(f"{folder}/files")


def read_ids(files: DataFrame, id_col: str = "doc_id", with_ids: bool = False, step: int = 1 << 16) -> DataFrame:
    """The documents of ``files``: id, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32`` (of its ids as
    little-endian 32-bit numbers), and ``ids`` if asked for.

    One row a file passes the driver, for the ids before it. A file is read in spans of ``step`` documents, each by any
    task: select finds where a span starts, and only its bytes are read.
    """
    spark, before, spans = files.sparkSession, 0, []
    for f in sorted(files.collect(), key=lambda f: (f.part, f.number)):
        spans.append((f.path, before, f.documents))
        before += f.ids
    spans = spark.createDataFrame(spans, "path string, before bigint, documents bigint").select(
        "path", "before", "documents", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("documents") - 1, F.lit(step).cast("bigint")))
        .alias("first")) if spans else spark.createDataFrame([], "path string, before bigint, documents bigint, first bigint")
    names = [id_col, "start", "n_tokens", "ids_crc32", *["ids"] * with_ids]
    types = [pa.int64()] * 4 + [pa.list_(pa.int32())] * with_ids

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    def run(batches):
        for batch in batches:
            for path, before, documents, first in zip(*(c.to_pylist() for c in batch.columns)):
                store, name = open_store(path)
                last, rows, held = min(documents, first + step), [], 0
                with store.open_input_file(name) as file:
                    found = IdFile(file)
                    for doc_id, (place, length, blocks) in zip(found.doc_ids(first, last), found.spans(first, last)):
                        crc, kept = 0, []
                        for block in blocks:
                            crc = zlib.crc32(block, crc)
                            if with_ids:
                                kept.append(block.astype("i4"))
                        rows.append((doc_id, before + place, length, crc, *[np.concatenate(kept) if kept else []] * with_ids))
                        held += length * with_ids
                        if len(rows) >= 10_000 or held >= 4 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                    if rows:
                        yield batch_of(rows)

    n = max(1, spans.count())
    schema = f"`{id_col}` bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    return (spans.repartition(n) if n > 1 else spans.coalesce(1)).mapInArrow(run, schema)


def token_files(docs: DataFrame, tokenizer: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Write the ids of all texts to files in the shared folder, and read the documents back (``write_ids``, ``read_ids``)."""
    folder = scratch_path(docs.sparkSession, "token-ids")
    return read_ids(write_ids(docs, tokenizer, folder, end_id, id_col, text_col, **options), id_col)
