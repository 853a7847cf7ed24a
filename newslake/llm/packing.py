"""Packing by power-of-two decomposition: documents become pieces whose lengths are powers of two.

Each piece is a sequence of its own in the bucket of its length, so no sequence crosses documents and none is padded.
A trainer reads one bucket at a time: equal lengths make full batches.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.llm import bpe
from newslake.llm.common import read_file


def lengths_of(n: int, largest: int) -> list:
    """``n`` as powers of two, largest first: as many of ``largest`` as fit, then the bits of the rest."""
    whole, rest = divmod(n, largest)
    return [largest] * whole + [1 << k for k in reversed(range(rest.bit_length())) if rest >> k & 1]


def pack(docs: DataFrame, tokenizer: str, max_length: int = 4096, end_id: int = 2, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of all documents; a document's ids are those of its text, as the tokenizers library gives them, and
    ``end_id``. They come from ``bpe``, whose words the worker keeps, at two thirds of the library's time.

    Columns: the id column, ``start`` (its document's ids before it), ``length``, ``ids_crc32`` (of little-endian
    32-bit ids), ``doc_tokens``, ``sequence_id``, ``offset`` (always 0), ``bucket`` (the length's exponent), and
    ``ids`` if asked for. A null text counts as empty: one piece with the end id alone. Repeated rows are packed as
    often as they occur, an empty table gives an empty table, other columns are not read. ``sequence_id`` is unique
    in one result; it is made from the input's partitions. There is no shuffle.
    """
    if max_length & (max_length - 1) or max_length < 1:
        raise ValueError("max_length must be a power of two")
    data = read_file(tokenizer)
    end = np.array([end_id], "<u4").tobytes()
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        encoder, _ = bpe.load(data)
        for batch in batches:
            owner, start, length, crc, total, ids = [], [], [], [], [], []
            for row, text in enumerate(batch.column(1)):
                block = encoder.encode(text.as_py() or "") + end
                at, n = 0, len(block) >> 2
                for size in lengths_of(n, max_length):
                    piece = block[at << 2:(at + size) << 2]
                    owner.append(row)
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(piece))
                    total.append(n)
                    if with_ids:
                        ids.append(np.frombuffer(piece, "<u4").astype("i4"))
                    at += size
            columns = [batch.column(0).take(pa.array(owner, pa.int64())),
                       *(pa.array(c, pa.int64()) for c in (start, length, crc, total))]
            names = [batch.schema.names[0], "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"`{id_col}` {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    pieces = docs.select(id_col, text_col).mapInArrow(run, schema + ", ids array<int>" * with_ids)
    return pieces.withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("bigint"),
                               "bucket": F.log2("length").cast("int")})


def write_buckets(pieces: DataFrame, path: str) -> None:
    """One folder for each length, written where the pieces are; a trainer reads the lengths it wants."""
    pieces.write.partitionBy("bucket").parquet(path)
