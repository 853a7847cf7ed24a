"""Hard negatives by rotated one-bit codes: popcounts estimate scores, intervals that are sure filter the candidates.

A vector ``v`` is turned by a fixed rotation and kept as the signs of its components, a unit vector ``b`` of one bit a
dimension, with its alignment ``a = <v, b>``. What the code leaves, ``r = v - a b``, is coded again under another
rotation, level by level. An anchor ``q`` is turned likewise and rounded to a few bits a dimension, so ``<q, b>`` is a
sum of popcounts over its bit planes. After any level

    <q, v> = sum of a <q, b> so far + <q, r>,    |<q, r>| <= |r| sqrt(|q|^2 - <q, b>^2)

with the level's own ``b``, as ``r`` is at right angles to it (Cauchy-Schwarz); ``|r|^2`` is ``|v|^2`` less all ``a^2``.
Rounding adds at most ``|a|`` times the length of what it left out. A row whose interval can no longer matter is dropped
at that level; those left after the last are scored in integers.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from newslake.llm.common import worker_state
from newslake.operators.common import attach
from newslake.session import staged

_PLANES = 8
_SLACK = 1e-6  # of the product of two lengths: far above what doubles lose, far below a score's step


def largest_component(dims: int) -> int:
    """The largest integer component for which scores are sure to fit a long."""
    return int((2 ** 62 // dims) ** 0.5) - 1


# ---- codes

def rotation(dims: int, level: int) -> np.ndarray:
    """A fixed orthogonal matrix for each level."""
    return worker_state(("rotation", dims, level), lambda: np.linalg.qr(
        np.random.default_rng(1_000 + level).standard_normal((dims, dims)))[0])


def _words(signs: np.ndarray) -> np.ndarray:
    """Rows of booleans as words of 64 bits."""
    packed = np.packbits(signs, axis=-1, bitorder="little")
    return np.ascontiguousarray(np.pad(packed, [(0, 0), (0, -packed.shape[1] % 8)])).view("<u8")


def encode(vectors: np.ndarray, levels: int):
    """Codes ``(rows, levels, words)`` and alignments ``(rows, levels)``."""
    dims, left, codes, aligned = vectors.shape[1], vectors.astype(float), [], []
    for level in range(levels):
        turn = rotation(dims, level)
        signs = left @ turn.T > 0
        unit = np.where(signs, dims ** -0.5, -dims ** -0.5) @ turn
        a = np.einsum("ij,ij->i", left, unit)
        left = left - a[:, None] * unit
        codes.append(_words(signs))
        aligned.append(a)
    return np.stack(codes, axis=1), np.stack(aligned, axis=1)


class Query:
    """An anchor, with its bit planes for each level."""

    def __init__(self, vector: np.ndarray, levels: int):
        self.vector, vector = vector, vector.astype(float)
        self.dims, self.length = len(vector), float(np.linalg.norm(vector))
        self.levels = []
        for level in range(levels):
            turned = rotation(self.dims, level) @ vector
            low = float(turned.min())
            step = (float(turned.max()) - low) / ((1 << _PLANES) - 1) or 1.0
            whole = np.rint((turned - low) / step).astype(np.int64)
            planes = _words((whole >> np.arange(_PLANES)[:, None] & 1).astype(bool))
            self.levels.append((planes, low, step, int(whole.sum()), float(np.linalg.norm(turned - low - step * whole))))

    def along(self, level: int, codes: np.ndarray):
        """``<q, b>`` for each code as popcounts give it, and how far off that may be."""
        planes, low, step, total, lost = self.levels[level]
        ones, inside = np.zeros(codes.shape[1], np.int64), np.zeros(codes.shape[1], np.int64)
        for word, code in enumerate(codes):
            ones += np.bitwise_count(code)
            for k, plane in enumerate(planes[:, word]):
                inside += np.bitwise_count(code & plane).astype(np.int64) << k
        # Signs are +1 or -1: a sum over them is twice the sum where they are +1, less the sum of all.
        return (step * (2 * inside - total) + low * (2 * ones - self.dims)) * self.dims ** -0.5, lost

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        """Exact integer scores; sums below 2^53 are exact in doubles too, and faster."""
        largest = max(int(np.abs(vectors).max(initial=0)), int(np.abs(self.vector).max(initial=0)))
        if self.dims * largest ** 2 < 1 << 53:
            return (vectors.astype(float) @ self.vector.astype(float)).astype(np.int64)
        return vectors @ self.vector


class Block:
    """Rows of one block, whose vectors are of one length."""

    def __init__(self, rows: pa.Table, levels: int):
        n, self.levels = rows.num_rows, levels
        column = {c: rows[c].combine_chunks() for c in rows.column_names}
        self.has_id = np.asarray(column["vec_id"].is_valid())
        self.ids = column["vec_id"].fill_null(0).to_numpy(zero_copy_only=False)
        self.labels = column["label"].to_numpy()
        self.vectors = np.frombuffer(b"".join(column["vector"].to_pylist()), "<i8").reshape(n, -1)
        codes = np.frombuffer(b"".join(column["codes"].to_pylist()), "<u8").reshape(n, levels, -1)
        self.codes = np.ascontiguousarray(codes.transpose(1, 2, 0))
        aligned = np.frombuffer(b"".join(column["aligned"].to_pylist()), "<f8").reshape(n, levels)
        self.aligned = np.ascontiguousarray(aligned.T)
        self.lengths = np.linalg.norm(self.vectors.astype(float), axis=1)
        self.left = np.sqrt(np.maximum(0.0, self.lengths ** 2 - np.cumsum(self.aligned ** 2, axis=0)))

    def narrowed(self, query: Query, rows: np.ndarray, keep) -> np.ndarray:
        """The rows that ``keep(lowest, highest)`` keeps at each level, by the intervals of their scores."""
        middle, spread = np.zeros(len(rows)), _SLACK * query.length * self.lengths[rows]
        for level in range(self.levels):
            a = self.aligned[level, rows]
            along, lost = query.along(level, self.codes[level][:, rows])
            middle += a * along
            spread += np.abs(a) * lost
            across = np.sqrt(np.maximum(0.0, query.length ** 2 - np.maximum(0.0, np.abs(along) - lost) ** 2))
            reach = spread + self.left[level, rows] * across
            stay = keep(middle - reach, middle + reach)
            rows, middle, spread = rows[stay], middle[stay], spread[stay]
        return rows

    def best(self, rows, scores, most: int):
        """The best rows and their scores: highest score first, then the smallest id, a null id last."""
        order = np.lexsort((self.ids[rows], ~self.has_id[rows], -scores))[:most]
        return rows[order], scores[order]

    def id_of(self, row):
        return int(self.ids[row]) if self.has_id[row] else None


# ---- the search in a block

def _sure(low, most, otherwise):
    """What ``most`` of the rows are sure to reach."""
    return np.partition(low, -most)[-most] if len(low) >= most else otherwise


def positives_in(block: Block, query: Query, anchor_id, label, most: int):
    """The best rows of the anchor's label in this block with their scores, and how many rows were scored for that."""
    rows = np.flatnonzero((block.labels == label) & ~(block.has_id & (block.ids == anchor_id)))
    if len(rows) > most:
        rows = block.narrowed(query, rows, lambda low, high: high >= _sure(low, most, -np.inf))
    return block.best(rows, query.scores(block.vectors[rows]), most), len(rows)


def negatives_in(block: Block, query: Query, label, windows, most: int):
    """For each window of scores the best rows of other labels in it, and how many rows were scored for that."""
    open_windows = [(a, b) for a, b in windows if a <= b]

    def keep(low, high):
        wanted = np.zeros(len(low), bool)
        for a, b in open_windows:
            wanted |= (high >= _sure(low[(low >= a) & (high <= b)], most, a)) & (low <= b)
        return wanted

    rows = np.flatnonzero(block.labels != label) if open_windows else np.empty(0, np.int64)
    rows = block.narrowed(query, rows, keep)
    scores = query.scores(block.vectors[rows])
    inside = [(scores >= a) & (scores <= b) for a, b in windows]
    return [block.best(rows[i], scores[i], most) for i in inside], len(rows)


# ---- the job

_CODED = "vec_id bigint, label bigint, dims int, vector binary, codes binary, aligned binary"


def coded_rows(rows: DataFrame, label: Column, scale: int, levels: int, id_col: str, vector_col: str) -> DataFrame:
    """The rows that take part, with integer vector, codes, alignments and a number of their own, as a stored table."""
    def run(batches):
        for batch in batches:
            sizes = np.asarray(batch.column(2).value_lengths())
            for dims in np.unique(sizes).tolist():
                part = batch.filter(pa.array(sizes == dims))
                whole = np.floor(scale * part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims))
                fits = (np.abs(whole) <= largest_component(dims)).all(axis=1)
                whole, part = whole[fits].astype("<i8"), part.filter(pa.array(fits))
                codes, aligned = encode(whole, levels)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(np.full(len(whole), dims, np.int32)),
                     *[pa.array([x.tobytes() for x in a], pa.binary()) for a in (whole, codes, aligned)]],
                    ["vec_id", "label", "dims", "vector", "codes", "aligned"])

    vector = F.col(vector_col).cast("array<double>")
    chosen = rows.select(F.col(id_col).cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"), vector.alias("vector")) \
        .filter(F.col("label").isNotNull() & (F.size("vector") > 0))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return staged(chosen.filter(finite).mapInArrow(run, _CODED).withColumn("row", F.monotonically_increasing_id()), "codes")


def _meet(table: DataFrame, anchors: DataFrame, row_blocks: int, anchor_blocks: int, run, schema: str) -> DataFrame:
    """``run(rows, anchors)`` for each pair of blocks. Blocks are dealt by a row's own number, so no id, label or vector
    fills one."""
    def dealt(rows, blocks, name, others, other):
        block = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias(name)
        # Columns of their own: both sides come from one table.
        return rows.select(*[F.col(c).alias(c) for c in rows.columns], block).select("*", F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other)) \
            .groupBy("rb", "ab", "dims")
    left = dealt(table, row_blocks, "rb", anchor_blocks, "ab")
    right = dealt(anchors, anchor_blocks, "ab", row_blocks, "rb")
    return left.cogroup(right).applyInArrow(run, schema)


def _best(found: DataFrame, by, score: str, vec_id: str, most: int) -> DataFrame:
    order = W.partitionBy(*by).orderBy(F.desc(score), F.asc_nulls_last(vec_id))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def mine(rows: DataFrame, anchors: str = "vec_id % 50 = 0", label: Column | None = None, scale: int = 256, n_positives: int = 5,
         n_negatives: int = 3, low: int = 50, high: int = 95, levels: int = 6, id_col: str = "vec_id",
         vector_col: str = "embedding", block_rows: int = 16_384, block_anchors: int = 4_096, least_blocks: int = 12) -> DataFrame:
    """For each anchor its best rows of the same label, and for each of these the best rows of other labels whose score is
    ``low`` to ``high`` hundredths of the positive's. Scores are inner products of ``floor(scale * x)``.

    Columns: ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``. Best is the highest score, then
    the smallest id; a row without id comes last. ``anchors`` is a condition on ``vec_id, label``. Rows with a null label or
    vector, or with a null or non-finite component take no part, nor do vectors without components and those whose
    integers are so large that a score need not fit a long (2^28 at 64 components). Vectors meet those with as many
    components. Rows with an anchor's own id are not its positives. Repeated rows count as often as they occur, as anchors
    too; an empty table gives an empty table, other columns are not read.

    Anchors meet all rows block by block: a block has about ``block_rows`` or ``block_anchors`` rows, fewer where vectors are
    long, and each pair of blocks sends ``n_positives`` or ``n_negatives`` rows on for an anchor or a positive at most.
    """
    table = coded_rows(rows, F.col("label") if label is None else label, scale, levels, id_col, vector_col)
    size = table.agg(F.count("*").alias("rows"), F.count_if(F.expr(anchors)).alias("anchors"), F.max("dims").alias("dims")).first()
    shorter = max(1, (size.dims or 1) // 128)
    blocks = (max(least_blocks, -(-size.rows * shorter // block_rows)), max(1, -(-size.anchors * shorter // block_anchors)))
    chosen = table.filter(anchors).select("row", "vec_id", "label", "dims", "vector")

    def near(block_table, anchor_table):
        out, asked = [], anchor_table.to_pylist() if block_table.num_rows else []
        block = Block(block_table, levels) if asked else None
        for a in asked:
            query = Query(np.frombuffer(a["vector"], "<i8"), levels)
            (found, scores), _ = positives_in(block, query, a["vec_id"], a["label"], n_positives)
            out += [(a["row"], block.id_of(r), int(s)) for r, s in zip(found, scores)]
        columns = zip(*out) if out else ([], [], [])
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["row", "positive_id", "positive_score"])

    def hard(block_table, anchor_table):
        out, asked = [], anchor_table.to_pylist() if block_table.num_rows else []
        block = Block(block_table, levels) if asked else None
        for a in asked:
            query = Query(np.frombuffer(a["vector"], "<i8"), levels)
            windows = [(-(-low * p["positive_score"] // 100), high * p["positive_score"] // 100) for p in a["positives"]]
            found, _ = negatives_in(block, query, a["label"], windows, n_negatives)
            out += [(a["row"], a["vec_id"], p["place"], p["positive_id"], p["positive_score"], block.id_of(r), int(s))
                    for p, (ids, scores) in zip(a["positives"], found) for r, s in zip(ids, scores)]
        names = ["row", "anchor_id", "place", "positive_id", "positive_score", "negative_id", "negative_score"]
        columns = zip(*out) if out else [[]] * len(names)
        return pa.table([pa.array(c, pa.int64()) for c in columns], names)

    positives = _best(_meet(table, chosen, *blocks, near, "row bigint, positive_id bigint, positive_score bigint"),
                      ["row"], "positive_score", "positive_id", n_positives)
    # A row for each anchor: its positives are at most ``n_positives``.
    lists = staged(positives.groupBy("row").agg(F.collect_list(F.struct(
        F.col("rank").cast("bigint").alias("place"), "positive_id", "positive_score")).alias("positives")), "positives")
    hard_rows = _meet(table, attach(chosen, lists, ["row"], "inner"), *blocks, hard,
                      "row bigint, anchor_id bigint, place bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint")
    best = _best(hard_rows, ["row", "place"], "negative_score", "negative_id", n_negatives)
    return best.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
