"""Toxicity: a weighted lexicon, matched by one Aho-Corasick automaton after folding, normalised by length.

Folding undoes look-alike letters, invisible characters and digits put in place of letters. The lexicon, its weights,
the phrases that excuse a word, and the rate at which a text counts as toxic are learned from labelled texts.
"""

import re
from bisect import bisect_right
from collections import Counter
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.llm import common  # noqa: F401  ships this package with its tasks
from newslake.session import staged

# Letters of other alphabets that look like Latin ones, and signs that stand in for letters.
_CYRILLIC = dict(zip("авеёікмнорстухјѕԁԛԝһӏ", "abeeikmhopctyxjsdqwhl"))
_GREEK = dict(zip("αβεηικνορτυχ", "abenikvoptux"))
_SIGNS = dict(zip("013457@$!|", "oieastasil"))
_HIDDEN = dict.fromkeys(map(chr, [0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF]), "")
_WIDE = {chr(0xFF41 + k): chr(97 + k) for k in range(26)} | {chr(0xFF10 + k): chr(48 + k) for k in range(10)}
_LETTERS = str.maketrans({**_CYRILLIC, **_GREEK, **_HIDDEN, **_WIDE})
_SIGN_TABLE = str.maketrans(_SIGNS)

_STAND_IN = re.compile(r"[013457@$!|]+(?=[^\W\d_])|(?<=[^\W\d_])[013457](?![\w@$!|])")
_WORD = re.compile(r"[^\W\d_]+")


def fold(text: str) -> str:
    """Lower case; look-alikes as Latin letters, stand-in signs before a letter (or a last digit) as that letter."""
    text = text.lower()
    if not text.isascii():
        text = text.translate(_LETTERS)
    return _STAND_IN.sub(lambda m: m[0].translate(_SIGN_TABLE), text)


def words_of(text: str) -> list:
    return _WORD.findall(fold(text))


class Lexicon:
    """Terms and phrases as patterns over ``" word word "``: a whole word has a space on both sides, a stem before it."""

    def __init__(self, weights: dict, excused=(), threshold: float = 1.0, prior: float = 20.0):
        self.weights, self.excused, self.threshold, self.prior = weights, frozenset(excused), threshold, prior

    def automaton(self):
        machine = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            machine.add_word(term, (len(term), weight))
        for phrase in self.excused:
            machine.add_word(f" {phrase} ", (len(phrase) + 2, None))
        machine.make_automaton()
        return machine

    def hits(self, machine, words):
        """``(start, weight)`` of each term outside excused phrases."""
        if not self.weights or not words:
            return []
        found = [(end - size + 1, end, weight) for end, (size, weight) in machine.iter(f" {' '.join(words)} ")]
        spans = sorted((a, b) for a, b, weight in found if weight is None)
        starts, reach = [a for a, _ in spans], list(accumulate((b for _, b in spans), max))

        def excused(a):
            """Is there a phrase that begins no later and goes on beyond?"""
            k = bisect_right(starts, a)
            return k > 0 and a + 1 < reach[k - 1]
        return [(a, w) for a, _, w in found if w is not None and not excused(a)]

    def rate(self, machine, words) -> float:
        """Weight of the hits for a hundred words, with some words added so that short texts do not run off."""
        return 100 * sum(w for _, w in self.hits(machine, words)) / (len(words) + self.prior)

    def score(self, rate: float) -> float:
        """0 without a hit, 0.3 at the learned threshold, towards 1 above."""
        return rate / (rate + self.threshold * 7 / 3)


def _word_counts(texts):
    """Texts with every distinct word of them, per label, in partial sums."""
    def run(batches):
        for batch in batches:
            counts = (Counter(), Counter())
            for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
                counts[label].update(set(words_of(text.as_py() or "")))
            words = list(counts[0] | counts[1])
            if words:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words), pa.array([counts[1][w] for w in words], pa.int64()),
                     pa.array([counts[0][w] for w in words], pa.int64())], ["word", "bad", "fine"])
    return texts.select("text", "toxic").mapInArrow(run, "word string, bad bigint, fine bigint")


def _families(texts):
    """One text of each family of copies, which would make any of its words look telling: the least of the hashes of
    runs of five words, and the label, name a family."""
    def run(batches):
        for batch in batches:
            keys = []
            for text in batch.column(0):
                words = words_of(text.as_py() or "")
                keys.append(min((hash_of(" ".join(words[i:i + 5])) for i in range(max(1, len(words) - 4))), default=0))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.int64())], ["text", "toxic", "family"])

    def hash_of(run_of_words):
        from xxhash import xxh64_intdigest
        return xxh64_intdigest(run_of_words.encode()) >> 1
    keyed = texts.select("text", "toxic").mapInArrow(run, "text string, toxic int, family bigint")
    return keyed.groupBy("family", "toxic").agg(F.min("text").alias("text"))


def _phrases(texts, lexicon):
    """Pairs of neighbours of which one is a term, with texts per label."""
    def run(batches):
        machine = lexicon.automaton()
        for batch in batches:
            phrases, labels = [], []
            for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
                words, seen = words_of(text.as_py() or ""), set()
                starts = {a for a, _ in lexicon.hits(machine, words)}
                at = 0
                for k, word in enumerate(words):
                    if at in starts:
                        seen.update(" ".join(words[i:i + 2]) for i in (k - 1, k) if 0 <= i < len(words) - 1)
                    at += len(word) + 1
                phrases += seen
                labels += [label] * len(seen)
            yield pa.RecordBatch.from_arrays([pa.array(phrases, pa.string()), pa.array(labels, pa.int32())], ["phrase", "toxic"])
    return texts.select("text", "toxic").mapInArrow(run, "phrase string, toxic int")


def _rates(texts, lexicon):
    def run(batches):
        machine = lexicon.automaton()
        for batch in batches:
            rates = [lexicon.rate(machine, words_of(text.as_py() or "")) for text in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(rates, pa.float64()), batch.column(1)], ["rate", "toxic"])
    return texts.select("text", "toxic").mapInArrow(run, "rate double, toxic int")


def _threshold(pairs) -> float:
    """The rate that parts the labels best. Half-way from the last clean to the first toxic text above it."""
    if not pairs:
        return 1.0
    rates, labels = (np.array(x, float) for x in zip(*sorted(pairs)))
    # At a cut before place k, toxic texts below and clean ones from there on are wrong.
    wrong = np.concatenate(([0], np.cumsum(labels))) + np.concatenate((np.cumsum((1 - labels)[::-1])[::-1], [0]))
    cuts = [k for k in range(1, len(rates)) if rates[k] > rates[k - 1]]
    if not cuts:
        return 1.0
    k = min(cuts, key=lambda c: wrong[c])
    return (rates[k - 1] + rates[k]) / 2


def fit(labelled: DataFrame, max_texts: int = 12_000, min_weight: float = 3.0, max_terms: int = 4_000,
        excused=("trash can", "trash bin", "clown fish")) -> Lexicon:
    """Learn from ``labelled(text, toxic)``, which the caller bounds to about ``max_texts`` rows.

    A term is a word, or a stem of four to eight letters of at least three words, whose odds of being in a toxic text
    are ``exp(min_weight)`` times those of a clean one, in at least three texts and a hundredth of the toxic ones.
    Families of copies count once. At most ``max_terms`` terms, the heaviest, and that many learned phrases are taken;
    these bounds and that of the texts are the model's, what it is applied to has none.
    """
    texts = staged(_families(labelled), "families")
    n = {r.toxic: r["count"] for r in texts.groupBy("toxic").count().collect()}
    bad_texts, fine_texts = n.get(1, 0), n.get(0, 0)
    if not bad_texts or not fine_texts:
        return Lexicon({})
    counted = staged(_word_counts(texts).groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("fine").alias("fine")), "words")
    weight = F.log((F.col("bad") + 0.5) / (bad_texts + 1)) - F.log((F.col("fine") + 0.5) / (fine_texts + 1))
    telling = (F.col("bad") >= max(3, bad_texts // 100)) & (weight >= min_weight)
    stems = counted.select(F.explode(F.transform(F.sequence(F.lit(4), F.lit(8)), lambda k: F.when(
        F.length("word") > k, F.left(F.col("word"), k)))).alias("stem"), "bad", "fine").filter(F.col("stem").isNotNull())
    stems = stems.groupBy("stem").agg(F.sum("bad").alias("bad"), F.sum("fine").alias("fine"),
                                      F.count_if(F.col("bad") > 0).alias("words"))
    heavy = [F.desc("weight"), F.col("term")]
    stem_rows = stems.filter((F.col("words") >= 3) & telling).select(F.col("stem").alias("term"), weight.alias("weight")) \
        .orderBy(*heavy).limit(max_terms).collect()
    word_rows = counted.filter(telling).select(F.col("word").alias("term"), weight.alias("weight")) \
        .orderBy(*heavy).limit(max_terms).collect()
    terms, taken = {}, []
    # The heaviest stem of a family is the purest one with its whole support; of equal ones the longest is taken.
    for row in sorted(stem_rows, key=lambda r: (-r.weight, -len(r.term), r.term)):
        if not any(row.term.startswith(t) or t.startswith(row.term) for t in taken):
            taken.append(row.term)
            terms[f" {row.term}"] = row.weight
    for row in word_rows:
        if not row.term.startswith(tuple(taken)):
            terms[f" {row.term} "] = row.weight
    found = _phrases(texts, Lexicon(terms)).groupBy("phrase").agg(
        F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("fine"))
    learned = found.filter((F.col("fine") >= 2) & (F.col("fine") * bad_texts > F.col("bad") * fine_texts)) \
        .orderBy(F.desc("fine"), "phrase").limit(max_terms).collect()
    lexicon = Lexicon(terms, [*excused, *(r.phrase for r in learned)])
    lexicon.threshold = _threshold([(r.rate, r.toxic) for r in _rates(texts, lexicon).collect()])
    return lexicon


def labelled_sample(docs: DataFrame, labels: DataFrame, usable, id_col: str = "doc_id", text_col: str = "text",
                    max_texts: int = 12_000) -> DataFrame:
    """Texts and labels to learn from: of the ``usable`` labelled ids, the ``max_texts`` least by hash."""
    known = labels.filter(F.col("toxic").isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(
        F.max("toxic").cast("int").alias("toxic"))
    chosen = staged(known.filter(usable(F.col("_id"))).orderBy(F.xxhash64("_id"), "_id").limit(max_texts), "chosen")
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(chosen, "_id").select("text", "toxic")


def score_documents(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text",
                    cut: float = 0.3) -> DataFrame:
    """The id column, ``score`` (0 to 1), ``predicted`` (1 from ``cut`` on), ``n_hits``; no shuffle.

    A null text counts as empty; texts without a word score 0. Repeated rows are repeated, an empty table gives an
    empty table, other columns of any name are not read. Whole texts of any length are matched.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        machine = lexicon.automaton()
        for batch in batches:
            scores, hits = [], []
            for text in batch.column(1):
                words = words_of(text.as_py() or "")
                found = lexicon.hits(machine, words)
                scores.append(lexicon.score(100 * sum(w for _, w in found) / (len(words) + lexicon.prior)))
                hits.append(len(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= cut) for s in scores], pa.int32()),
                 pa.array(hits, pa.int64())], [batch.schema.names[0], "score", "predicted", "n_hits"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, score double, predicted int, n_hits bigint")


def held_out(doc_id):
    """A quarter of the ids is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
