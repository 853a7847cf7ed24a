"""SimHash near-duplicates by vantage-point trees.

Fingerprints are points under Hamming distance. Four differing bits leave at most one in some of three blocks of bits,
so a tree is built for each block, on the distance within it. A node of a tree has a vantage point and a radius and
parts its points into those inside and outside. By the triangle inequality a pair that is parted differs by no more
than the block's bound in its distances to the vantage point, so only the two thin shells at the boundary meet across
it, as a node of their own with two sides. The upper levels, which all nodes of a level share, deal the points out to
shards; the lower ones are built within a shard.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.llm.common import unused
from newslake.llm.components import connected
from newslake.session import staged

SEED = 42
_BLOCK = 1 << 16


def fingerprint(text: str, words_each: int = 4) -> int:
    """SimHash of the shingles of ``words_each`` words; A-Z are folded, ASCII white space parts words."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    last = (ends - 1)[min(words_each, len(words)) - 1:]
    starts, last = starts[:len(last)].tolist(), last.tolist()
    digest, counts, n = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(last)
    for k in range(0, n, _BLOCK):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[k:k + _BLOCK], last[k:k + _BLOCK])], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_each: int = 4) -> DataFrame:
    """The id column and ``fp``, the fingerprint as a signed 64-bit number; no shuffle."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            prints = np.array([fingerprint(text.as_py() or "", words_each) for text in batch.column(1)], "<u8")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view("<i8"))],
                                             [batch.schema.names[0], "fp"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, fp bigint")


def blocks_of(max_bits: int, blocks: int):
    """Masks of ``blocks`` runs of bits, and the bits that a pair may differ by in at least one of them."""
    edges = [64 * k // blocks for k in range(blocks + 1)]
    masks = [np.uint64(((1 << hi - lo) - 1) << lo) for lo, hi in zip(edges, edges[1:])]
    return masks, max_bits // blocks


def _distance(points, vantage):
    return np.bitwise_count(points ^ vantage).astype(np.int8)


def choose(sample, radius):
    """The vantage point and radius that leave the fewest pairs of the sample to compare, and what share that is."""
    best = (2.0, None, 0)
    for vantage in sample[:24]:
        share = np.bincount(_distance(sample, vantage), minlength=66) / len(sample)
        inside = np.cumsum(share)
        for mu in range(64):
            p = inside[mu]
            if not 0.05 < p < 0.95:
                continue
            shell_in, shell_out = share[max(0, mu - radius + 1):mu + 1].sum(), share[mu + 1:mu + radius + 1].sum()
            cost = p * p + (1 - p) ** 2 + 2 * shell_in * shell_out
            if cost < best[0]:
                best = (cost, vantage, mu)
    return best


def shells(d, mu, radius):
    """Who is inside, who is in the shell inside the boundary, and who in the shell outside it."""
    inside = d <= mu
    return inside, inside & (d > mu - radius), ~inside & (d <= mu + radius)


def deal(points, levels, mask, radius):
    """Shard codes of ``points``: rows ``(place, code, side)``, side 0 in a node of its own, 1 or 2 across a boundary."""
    place = np.arange(len(points))
    code, side = np.zeros(len(points), np.int64), np.zeros(len(points), np.int8)
    for vantage, mu in levels:
        inside, shell_in, shell_out = shells(_distance((points[place]) & mask, vantage), mu, radius)
        own = side == 0
        parts = [(np.ones(len(place), bool), np.where(inside, 0, 1), side)]
        # Own node to a new node across; sides of an older one meet straight or, from the shells, crosswise.
        parts.append((own & shell_in, 2, 1))
        parts.append((own & shell_out, 2, 2))
        parts.append(((side == 1) & shell_in | (side == 2) & shell_out, 2, side))
        parts.append(((side == 1) & shell_out | (side == 2) & shell_in, 3, side))
        place, code, side = (np.concatenate(x) for x in zip(*(
            (place[who], code[who] * 4 + (digit[who] if isinstance(digit, np.ndarray) else digit),
             side[who] if isinstance(to, np.ndarray) else np.full(int(who.sum()), to, np.int8))
            for who, digit, to in parts)))
    return place, code, side


class Linker:
    """All links between points of one shard, as a label for each point; pairs are compared, never listed."""

    def __init__(self, points, mask, radius, max_bits):
        self.points, self.mask, self.radius, self.max_bits = points, mask, radius, max_bits
        self.others = ~mask  # bits that no tree above has looked at
        self.label = np.arange(len(points))

    def _rows(self, rows, columns):
        """Compare every row with every column, 64 with 65,536 at a time."""
        for k in range(0, len(rows), 64):
            part = rows[k:k + 64]
            for at in range(0, len(columns), 1 << 16):
                some = columns[at:at + (1 << 16)]
                near = np.bitwise_count(self.points[part][:, None] ^ self.points[some][None, :]) <= self.max_bits
                near &= self.label[part][:, None] != self.label[some][None, :]
                i, j = np.nonzero(near)
                if len(i):
                    self._join(np.unique(np.stack((self.label[part[i]], self.label[some[j]]), 1), axis=0))

    def _deeper(self, search, *sides):
        """For points that these bits do not part: trees on each half of the bits not yet looked at, in one of which
        linked points differ in half of ``max_bits`` at most. Where no bits are left, all are compared."""
        bits = [b for b in range(64) if int(self.others) >> b & 1]
        if len(bits) < 16:
            self._dense(np.unique(np.concatenate(sides)))
            return
        before = self.mask, self.radius, self.others
        for half in (bits[:len(bits) // 2], bits[len(bits) // 2:]):
            self.mask = np.uint64(sum(1 << b for b in half))
            self.radius, self.others = self.max_bits // 2, np.uint64(int(before[2]) & ~int(self.mask))
            search(*sides)
        self.mask, self.radius, self.others = before

    def _join(self, pairs):
        root = {}

        def find(x):
            while (up := root.get(x, x)) != x:
                x = up
            return x
        for a, b in pairs.tolist():
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
        changed = np.arange(len(self.label))
        for x in root:
            changed[x] = find(x)
        self.label = changed[self.label]

    def _dense(self, who):
        """For points that no vantage point parts: once most are one component, only the rest is compared with all."""
        left = np.ones(len(who), bool)
        while left.any():
            labels = self.label[who]
            values, counts = np.unique(labels, return_counts=True)
            main = labels == values[counts.argmax()]
            rows = np.flatnonzero(left & main)[:64]
            before = main.sum()
            if len(rows):
                left[rows] = False
                self._rows(who[rows], who)
                if (self.label[who] == self.label[who[rows[0]]]).sum() >= before + 64:
                    continue
            rows = np.flatnonzero(left & (self.label[who] != self.label[who[main.argmax()]]))
            if not len(rows):
                return
            rows = rows[:4096]
            left[rows] = False
            self._rows(who[rows], who)

    def _split(self, who):
        rng = np.random.default_rng(len(who))
        sample = self.points[rng.choice(who, min(len(who), 256), replace=False)] & self.mask
        return choose(sample, self.radius)

    def own(self, who):
        if len(who) <= 768:
            self._rows(who, who)
            return
        cost, vantage, mu = self._split(who)
        if cost > 0.9:
            self._deeper(self.own, who)
            return
        inside, shell_in, shell_out = shells(_distance(self.points[who] & self.mask, vantage), mu, self.radius)
        self.own(who[inside])
        self.own(who[~inside])
        self.across(who[shell_in], who[shell_out])

    def across(self, a, b):
        if not len(a) or not len(b):
            return
        if len(a) * len(b) <= 1 << 19:
            self._rows(*((a, b) if len(a) <= len(b) else (b, a)))
            return
        cost, vantage, mu = self._split(np.concatenate((a, b)))
        if cost > 0.9:
            self._deeper(self.across, a, b)
            return
        (ia, sia, soa), (ib, sib, sob) = (
            shells(_distance(self.points[x] & self.mask, vantage), mu, self.radius) for x in (a, b))
        self.across(a[ia], b[ib])
        self.across(a[~ia], b[~ib])
        self.across(a[sia], b[sob])
        self.across(a[soa], b[sib])

    def links(self):
        moved = np.flatnonzero(self.label != np.arange(len(self.label)))
        return self.points[moved], self.points[self.label[moved]]


def near_links(points: DataFrame, max_bits: int = 4, blocks: int = 3, shard: int = 1 << 16,
               sample: int = 512) -> DataFrame:
    """Links ``a, b`` that connect exactly the points which pairs of at most ``max_bits`` differing bits connect.

    ``points`` has distinct ``fp``. Vantage points of the upper levels come from ``sample`` points (least by hash; it
    only steers the speed); there are as many levels as shards of ``shard`` points need. Each shard gives a spanning
    forest of its links. A radius of 0 bits in a block means that no shells are copied.
    """
    spark = points.sparkSession
    masks, radius = blocks_of(max_bits, blocks)
    n = points.count()
    depth = max(0, int(np.ceil(np.log2(max(1, n) / shard))))
    chosen = np.array([r.fp for r in points.orderBy(F.xxhash64("fp"), "fp").limit(sample).collect()], "<i8").view("<u8")
    trees = []
    for mask in masks:
        masked, levels = chosen & mask, []
        for level in range(depth):
            cost, vantage, mu = choose(np.roll(masked, -24 * level), radius)
            if vantage is not None and cost <= 0.9:
                levels.append((vantage, mu))
        trees.append((mask, levels))

    def route(batches):
        for batch in batches:
            values = np.asarray(batch.column(0)).view("<u8")
            for number, (mask, levels) in enumerate(trees):
                place, code, side = deal(values, levels, mask, radius)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(place), number, np.int32)), pa.array(code), pa.array(side),
                     pa.array(values[place].view("<i8"))], ["tree", "code", "side", "fp"])

    def link(group):
        values, side = group["fp"].to_numpy().view("<u8"), group["side"].to_numpy()
        mask = masks[group["tree"][0].as_py()]
        linker, everyone = Linker(values, mask, radius, max_bits), np.arange(len(values))
        if (side == 0).any():
            linker.own(everyone)
        else:
            linker.across(everyone[side == 1], everyone[side == 2])
        a, b = linker.links()
        return pa.table({"a": a.view("<i8"), "b": b.view("<i8")})

    routed = points.select("fp").mapInArrow(route, "tree int, code bigint, side byte, fp bigint")
    return staged(routed.groupBy("tree", "code").applyInArrow(link, "a bigint, b bigint"), "near")


def near_duplicates(docs: DataFrame, max_bits: int = 4, words_each: int = 4, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """The fingerprint and component of every row.

    Columns: the id column, ``fingerprint`` (16 lower-case hex digits), ``component_id`` (the least id that links
    reach, its own included). Texts without a word, null ones too, have fingerprint zero and are linked like any
    other. Repeated rows are repeated with one component; a null id is never the least. An empty table gives an empty
    table; other columns of any name are not read. Long texts are hashed in blocks of shingles.
    """
    prints = staged(fingerprints(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")), "id", "t", words_each), "prints")
    points = staged(prints.groupBy("fp").agg(F.min("id").alias("rep")), "points")
    nodes = staged(connected(near_links(points, max_bits)), "nodes")
    joined = points.join(nodes, F.col("fp") == F.col("node"), "left").select(
        "fp", "rep", F.coalesce("root", "fp").alias("root"))
    least = points.join(nodes, F.col("fp") == F.col("node")).groupBy("root").agg(F.min("rep").alias("least"))
    classes = joined.join(least, "root", "left").select("fp", F.coalesce("least", "rep").alias("component_id"))
    return prints.join(classes, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, max_bits: int = 4, words_each: int = 4, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """The row with the least id of each component, with all its columns.

    Ids name documents here: of rows that share the id that stays, one is picked. A component without any id stays
    whole.
    """
    answer = near_duplicates(docs, max_bits, words_each, id_col, text_col)
    key, copies = unused(docs, "key", "copies")
    stays = answer.filter(F.col(id_col).eqNullSafe(F.col("component_id"))).groupBy(F.col(id_col).alias(key)).agg(
        F.count("*").alias(copies))
    found = docs.join(stays, F.col(id_col).eqNullSafe(F.col(key)))
    one = F.col(key).isNull() | (F.col(copies) == 1)
    return found.filter(one).unionByName(found.filter(~one).dropDuplicates([key])).select(*docs.columns)
