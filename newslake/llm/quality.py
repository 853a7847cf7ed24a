"""Quality rules by line labelling: a linear-chain conditional random field marks lines as content or boilerplate.

Viterbi decoding gives each document's best labelling; the share of its words that stands in content lines decides
whether it stays. Some plain rules go before. The field is trained here from documents with a quality label.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.llm.common import WHITE
from newslake.session import staged

SYMBOLS = "#*$%&|<>"
BOILERPLATE, CONTENT = 0, 1
_SYMBOL_BYTES, _UPPER, _DIGITS = SYMBOLS.encode(), bytes(range(65, 91)), bytes(range(48, 58))
_SHARES = np.array([0.0001, 0.01, 0.03, 0.1, 0.2, 0.4])
_COUNTS = np.array([2, 4, 8, 16, 32, 64, 128])
_FEATURES = [(name, len(_SHARES) + 1) for name in ("symbols", "capitals", "digits", "exclamations", "bars", "repeats")] \
    + [("words", len(_COUNTS) + 1), ("word length", len(_COUNTS) + 1), ("ending", 4), ("seen", 2)]
_BASE = np.cumsum([0] + [n for _, n in _FEATURES])
N_FEATURES = int(_BASE[-1])
_ENDINGS = {b".": 1, b"!": 2, b"?": 2, b"|": 3}


@dataclass
class Base:
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int

    def failed(self) -> bool:
        return self.n_words < 50 or 100 * self.n_repeat_words > 50 * self.n_words


def repeated_words(words: list, window: int = 3) -> int:
    """Words that stand in a run of ``window`` words which the text has at least twice."""
    if len(words) <= window:
        return 0
    known = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    runs = ids[:len(ids) - window + 1]
    for k in range(1, window):
        runs = runs * len(known) + ids[k:len(ids) - window + 1 + k]
        if len(known) > 1 << 20:  # keys of a huge vocabulary are numbered anew, so that they fit
            runs = np.unique(runs, return_inverse=True)[1]
    _, place, counts = np.unique(runs, return_inverse=True, return_counts=True)
    twice = counts[place] > 1
    covered = np.zeros(len(ids), bool)
    for k in range(window):
        covered[k:k + len(twice)] |= twice
    return int(covered.sum())


def lines_of(text: str) -> list:
    return [line for line in text.split("\n") if line.strip(WHITE)]


def measure(text: str, lines: list) -> Base:
    words = text.encode().split()
    return Base(len(words), len(text) - sum(map(text.count, WHITE)) if words else 0, sum(map(text.count, SYMBOLS)),
                len(lines) - len(set(lines)), repeated_words(words))


def line_features(lines: list):
    """The features of each line as places in the weight vector, and its words."""
    shares, counts, other, seen = [], [], [], set()
    for line in lines:
        data = line.encode()
        words, size = data.split(), len(data)
        n = len(words)
        shares.append(((size - len(data.translate(None, _SYMBOL_BYTES))) / size, (size - len(data.translate(None, _UPPER))) / size,
                       (size - len(data.translate(None, _DIGITS))) / size, data.count(b"!") / size,
                       data.count(b"|") / size, 1 - len(set(words)) / n))
        counts.append((n, size / n))
        other.append((_ENDINGS.get(words[-1][-1:], 0), line in seen))
        seen.add(line)
    places = np.concatenate((np.searchsorted(_SHARES, np.array(shares), "right"),
                             np.searchsorted(_COUNTS, np.array(counts), "right"), np.array(other, np.int64)), axis=1)
    return places + _BASE[:-1], np.array([c[0] for c in counts])


class Field:
    """Weights of a linear chain with two labels: of a line's features, of neighbours, of the first line."""

    def __init__(self, emit=None, move=None, first=None):
        self.emit = np.zeros((N_FEATURES, 2)) if emit is None else emit
        self.move = np.zeros((2, 2)) if move is None else move
        self.first = np.array([0.0, 1e-6]) if first is None else first

    def decode(self, places) -> np.ndarray:
        """Viterbi: the labelling of highest score; of equal ones, content."""
        scores = self.emit[places].sum(axis=1).tolist()
        (m00, m01), (m10, m11) = self.move.tolist()
        a, b = self.first[0] + scores[0][0], self.first[1] + scores[0][1]
        back = []
        for s0, s1 in scores[1:]:
            a0, b0, a1, b1 = a + m00, b + m10, a + m01, b + m11
            back.append((b0 >= a0, b1 >= a1))
            a, b = (b0 if b0 >= a0 else a0) + s0, (b1 if b1 >= a1 else a1) + s1
        label = int(b >= a)
        labels = [label]
        for came in reversed(back):
            label = int(came[label])
            labels.append(label)
        return np.array(labels[::-1])

    def train(self, places, mask, labels, rounds: int = 150, rate: float = 0.1, decay: float = 1e-3, begins=None):
        """Maximise the conditional likelihood of ``labels`` over padded sequences ``(sequence, line, feature)``.

        ``begins`` says which sequences begin a text, all unless given; in the others the first line is as any other.
        """
        n, length = mask.shape
        begins = np.ones((n, 1)) if begins is None else np.asarray(begins, float).reshape(n, 1)
        weights = [self.emit, self.move, self.first]
        moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
        gold = np.eye(2)[labels] * mask[..., None]
        pairs = mask[:, 1:, None, None] * 1.0
        gold_move = (gold[:, :-1, :, None] * gold[:, 1:, None, :]).sum((0, 1))
        total = mask.sum()
        # Many lines have the same features; each such set is scored once.
        sets, of_line = np.unique(places[mask], axis=0, return_inverse=True)
        of_line, scores = of_line.ravel(), np.zeros((n, length, 2))
        for step in range(1, rounds + 1):
            scores[mask] = self.emit[sets].sum(axis=1)[of_line]
            ahead, behind = np.zeros((n, length, 2)), np.zeros((n, length, 2))
            ahead[:, 0] = self.first * begins + scores[:, 0]
            for t in range(1, length):
                x = np.logaddexp.reduce(ahead[:, t - 1, :, None] + self.move, axis=1) + scores[:, t]
                ahead[:, t] = np.where(mask[:, t, None], x, ahead[:, t - 1])
            for t in range(length - 2, -1, -1):
                x = np.logaddexp.reduce(self.move + (scores[:, t + 1] + behind[:, t + 1])[:, None, :], axis=2)
                behind[:, t] = np.where(mask[:, t + 1, None], x, 0)
            norm = np.logaddexp.reduce(ahead[:, -1], axis=1)
            node = np.exp(ahead + behind - norm[:, None, None]) * mask[..., None]
            edge = np.exp(ahead[:, :-1, :, None] + self.move + (scores + behind)[:, 1:, None, :]
                          - norm[:, None, None, None]) * pairs
            miss = (gold - node)[mask]
            by_set = [np.bincount(of_line, miss[:, y], len(sets)) for y in (0, 1)]
            emit = np.stack([np.bincount(sets.ravel(), np.repeat(x, sets.shape[1]), N_FEATURES) for x in by_set], 1)
            slopes = [emit, gold_move - edge.sum((0, 1)), ((gold[:, 0] - node[:, 0]) * begins).sum(0)]
            for w, g, (m, v) in zip(weights, slopes, moments):
                g = g / total - decay * w
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w += rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        return self


def fit(docs: DataFrame, labels: DataFrame, max_texts: int = 3_000, max_lines: int = 64, id_col: str = "doc_id",
        text_col: str = "text") -> Field:
    """Train from documents with a ``quality`` label: the lines of good ones are content, of bad ones boilerplate.

    That is a weak label, for bad documents hold some good lines; as such lines are many in good documents, they
    come out as content. Learned from: of each quality, the half of ``max_texts`` ids that are least by hash, with all
    lines of their texts, cut into chains of ``max_lines`` lines; texts are taken whole, in the order of the hash, as long as
    they have ``4 * max_texts`` chains together. These bounds on graded texts are the trainer's alone. Without labels of both kinds
    the field is empty and marks all as content.
    """
    known = labels.filter(F.col("quality").isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(
        F.min("quality").cast("int").alias("quality"))
    halves = [known.filter(F.col("quality") == q).orderBy(F.xxhash64("_id"), "_id").limit(max_texts // 2) for q in (0, 1)]
    chosen = staged(halves[0].union(halves[1]), "graded")

    def run(batches):
        for batch in batches:
            rows, chains, of_text = [], [], []
            for k, text in enumerate(batch.column(1)):
                lines = lines_of(text.as_py() or "")
                found = line_features(lines)[0] if lines else []
                for chain, at in enumerate(range(0, len(found), max_lines)):
                    rows.append(found[at:at + max_lines].ravel().astype(np.int32))
                    chains.append(chain)
                    of_text.append(k)
            of_text = pa.array(of_text, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(of_text), pa.array(chains, pa.int64()), pa.array(rows, pa.list_(pa.int32())), batch.column(2).take(of_text)],
                ["_id", "chain", "places", "quality"])

    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(chosen, "_id").select("_id", "text", "quality")
    kind = texts.schema["_id"].dataType.simpleString()
    cut = staged(texts.mapInArrow(run, f"_id {kind}, chain bigint, places array<int>, quality int"), "chains")
    # A count for each of the graded texts, which are few.
    taken, total = [], 0
    for row in cut.groupBy("_id").count().orderBy(F.xxhash64("_id"), "_id").collect():
        if total + row["count"] <= 4 * max_texts:
            taken.append(row["_id"])
            total += row["count"]
    kept = cut if len(taken) == cut.select("_id").distinct().count() else cut.filter(F.col("_id").isin(taken))
    rows = kept.orderBy(F.xxhash64("_id", "chain"), "_id", "chain").select("chain", "places", "quality").collect()
    if {r.quality for r in rows} != {0, 1}:
        return Field()
    width = len(_FEATURES)
    length = max(len(r.places) for r in rows) // width
    places, mask = np.zeros((len(rows), length, width), np.int64), np.zeros((len(rows), length), bool)
    for k, row in enumerate(rows):
        n = len(row.places) // width
        places[k, :n] = np.array(row.places).reshape(n, width)
        mask[k, :n] = True
    graded = np.repeat(np.array([r.quality for r in rows])[:, None], length, axis=1)
    return Field().train(places, mask, graded, begins=[r.chain == 0 for r in rows])


def judge(text: str, field: Field, min_share: float = 0.5):
    """Base figures, share of words in content lines, verdict."""
    lines = lines_of(text)
    base = measure(text, lines)
    if not lines:
        return base, 0.0, False
    places, words = line_features(lines)
    share = float(words[field.decode(places) == CONTENT].sum() / words.sum())
    return base, share, not base.failed() and share >= min_share


def assess(docs: DataFrame, field: Field, min_share: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, content_share``.

    A null text counts as empty; texts without a word have zeros and fail. Repeated rows are repeated, an empty table
    gives an empty table, other columns of any name are not read. Whole texts of any length are labelled.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches):
        for batch in batches:
            judged = [judge(text.as_py() or "", field, min_share) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([getattr(b, c) for b, _, _ in judged], pa.int64()) for c in counts),
                 pa.array([b.failed() for b, _, _ in judged], pa.bool_()), pa.array([k for _, _, k in judged], pa.bool_()),
                 pa.array([s for _, s, _ in judged], pa.float64())],
                [batch.schema.names[0], *counts, "base_failed", "kept", "content_share"])

    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, {', '.join(f'{c} bigint' for c in counts)}, base_failed boolean, kept boolean, content_share double")


def keep_good(docs: DataFrame, field: Field, min_share: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows that ``assess`` keeps, with all their columns; they are dropped where they are read."""
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array([judge(text.as_py() or "", field, min_share)[2] for text in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
