"""Toxicity and quality rules: folding, matching and decoding by brute force, accuracy on rows not learned from."""

import collections
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from cases import documents, empty, plain
from pyspark.sql import functions as F

from newslake.llm import quality, toxicity
from newslake.llm.common import table

SF = "/root/testdata/sf0.1"


# ---- toxicity

def test_folding():
    assert toxicity.words_of("you 1d10t") == ["you", "idiot"]
    assert toxicity.words_of("Idiоt $tupid sc​um ｌｏｓｅｒ los3") == ["idiot", "stupid", "scum", "loser", "lose"]
    assert toxicity.words_of("price $5 100 ***A$$$ éÉ ß") == ["price", "a", "éé", "ß"]
    assert toxicity.words_of("") == []


def test_stems_words_and_excuses():
    lexicon = toxicity.Lexicon({" bad ": 2.0, " wor": 3.0}, ["bad luck"], threshold=1.0)
    machine = lexicon.automaton()
    hits = lambda text: lexicon.hits(machine, toxicity.words_of(text))
    assert [w for _, w in hits("bad bad, badly worst Worse word sword")] == [2.0, 2.0, 3.0, 3.0, 3.0]
    assert hits("what bad luck") == [] and len(hits("bad bad luck bad")) == 2
    assert toxicity.Lexicon({}).hits(None, ["a"]) == []


def test_matching_equals_a_plain_search():
    rng = random.Random(2)
    terms = {" ab ": 1.0, " ba": 2.0, " a ": 4.0, " bb": 8.0}
    lexicon = toxicity.Lexicon(terms, ["a b", "ba ab"])
    machine = lexicon.automaton()
    for _ in range(300):
        words = ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(12))]
        text, want = f" {' '.join(words)} ", []
        spans = [(m.start(), m.start() + len(p) + 2) for p in lexicon.excused for m in re.finditer(f"(?= {p} )", text)]
        for term, weight in terms.items():
            for m in re.finditer(f"(?={term})", text):
                if words and not any(a <= m.start() and m.start() + 1 < b - 1 for a, b in spans):
                    want.append((m.start(), weight))
        assert sorted(lexicon.hits(machine, words)) == sorted(want), words


def test_threshold_parts_labels():
    assert toxicity._threshold([(0.0, 0), (0.0, 0), (2.0, 1), (4.0, 1)]) == 1.0
    assert 2 < toxicity._threshold([(0.0, 0), (2.0, 0), (3.0, 1), (1.0, 0), (4.0, 1), (0.0, 1)]) < 3
    assert toxicity._threshold([]) == 1.0


def test_held_out_is_the_checksum_of_the_id(spark):
    rows = spark.range(200).select("id", toxicity.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in rows)


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    lexicon = toxicity.fit(toxicity.labelled_sample(docs, labels, lambda i: ~toxicity.held_out(i)))
    rows = toxicity.score_documents(docs, lexicon).join(labels, "doc_id").filter(toxicity.held_out(F.col("doc_id"))) \
        .groupBy("toxic", "predicted").count().collect()
    n = {(r.toxic, r.predicted): r["count"] for r in rows}
    caught, missed, wrong = n.get((1, 1), 0), n.get((1, 0), 0), n.get((0, 1), 0)
    assert caught / (caught + missed) > 0.9 and wrong / (wrong + n[0, 0]) < 0.01


def test_labels_held_out_are_not_learned(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    lexica = [toxicity.fit(toxicity.labelled_sample(docs, x, lambda i: ~toxicity.held_out(i))) for x in (labels, flipped)]
    assert lexica[0].weights == lexica[1].weights and lexica[0].threshold == lexica[1].threshold


@pytest.mark.parametrize("clashes", [False, True])
def test_score_edge_cases(spark, clashes):
    docs = documents(spark, with_clashes=clashes)
    got = plain(toxicity.score_documents(docs, toxicity.Lexicon({" one ": 5.0}, threshold=1.0)))
    assert len(got) == docs.count()
    assert all(0 <= s <= 1 and p == int(s >= 0.3) for _, s, p, _ in got)
    assert {i: n for i, _, _, n in got if i is not None and n} == {3: 1, 4: 1}
    assert toxicity.score_documents(empty(docs), toxicity.Lexicon({})).count() == 0


def test_nothing_to_learn_from(spark):
    docs = documents(spark)
    none = spark.createDataFrame([(1, None), (None, 1), (2, 0)], "doc_id bigint, toxic int")
    for labels in (none, empty(none)):
        lexicon = toxicity.fit(toxicity.labelled_sample(docs, labels, lambda i: F.lit(True)))
        assert lexicon.weights == {}
        assert {r.score for r in toxicity.score_documents(docs, lexicon).collect()} == {0.0}


# ---- quality

def brute_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    runs = collections.Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for k in range(len(words) - 2):
        if runs[tuple(words[k:k + 3])] > 1:
            covered |= {k, k + 1, k + 2}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered))


@pytest.mark.parametrize("clashes", [False, True])
def test_base_figures(spark, clashes):
    texts = ["a b c a b c", "a a a a", "x|y\n x|y\nx|y\v\x85z", "w " * 60, " ".join(f"w{k}" for k in range(60))]
    docs = documents(spark, [*documents(spark).select("text").toPandas()["text"][:16], *texts], clashes)
    rows = quality.assess(docs, quality.Field()).collect()
    assert len(rows) == docs.count()
    texts_by_id = {r.doc_id: r.text or "" for r in docs.collect() if r.doc_id is not None}
    for r in rows:
        if r.doc_id is not None:
            base = brute_base(texts_by_id[r.doc_id])
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base
            assert r.base_failed == (base[0] < 50 or 100 * base[4] > 50 * base[0])
            assert r.kept == (not r.base_failed)  # an empty field marks all as content
    kept = quality.keep_good(docs, quality.Field())
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in rows)
    assert quality.assess(empty(docs), quality.Field()).count() == 0


def test_repeats_of_random_words():
    rng = random.Random(6)
    for _ in range(200):
        words = [rng.choice("abcd") for _ in range(rng.randrange(30))]
        assert quality.repeated_words(words) == brute_base(" ".join(words))[4]


def test_viterbi_finds_the_best_labelling():
    rng = np.random.default_rng(3)
    for _ in range(100):
        field = quality.Field(rng.normal(size=(quality.N_FEATURES, 2)), rng.normal(size=(2, 2)), rng.normal(size=2))
        places = rng.integers(0, quality.N_FEATURES, (int(rng.integers(1, 8)), 5))
        emit = field.emit[places].sum(1)

        def score(labels):
            return field.first[labels[0]] + sum(emit[k, y] for k, y in enumerate(labels)) \
                + sum(field.move[a, b] for a, b in zip(labels, labels[1:]))
        best = max(itertools.product((0, 1), repeat=len(places)), key=score)
        assert tuple(field.decode(places)) == best


def test_training_climbs_the_likelihood():
    """The trained field tells a feature apart, and its gradient is that of the likelihood over all labellings."""
    rng = np.random.default_rng(4)
    places = rng.integers(0, 4, (50, 6, 1))
    mask = np.arange(6)[None, :] < rng.integers(1, 7, 50)[:, None]
    labels = (places[..., 0] >= 2).astype(int)
    field = quality.Field().train(places, mask, labels, rounds=200)
    assert all((field.decode(p[m]) == y[m]).all() for p, m, y in zip(places, mask, labels))

    def loss(f):
        total = 0.0
        for p, m, y in zip(places, mask, labels):
            emit, y = f.emit[p[m]].sum(1), y[m]
            each = [f.first[z[0]] + sum(emit[k, v] for k, v in enumerate(z)) + sum(f.move[a, b] for a, b in zip(z, z[1:]))
                    for z in itertools.product((0, 1), repeat=len(y))]
            gold = f.first[y[0]] + sum(emit[k, v] for k, v in enumerate(y)) + sum(f.move[a, b] for a, b in zip(y, y[1:]))
            total += gold - np.logaddexp.reduce(each)
        return total
    assert loss(field) > loss(quality.Field()) + 50


def test_low_quality_documents_go_and_good_ones_stay(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    field = quality.fit(docs, labels, max_texts=400)
    rows = quality.assess(docs, field).join(labels, "doc_id").filter("NOT base_failed").groupBy("quality", "kept").count().collect()
    n = {(r.quality, r.kept): r["count"] for r in rows}
    assert n[1, True] / (n[1, True] + n.get((1, False), 0)) > 0.995
    assert n[0, False] / (n[0, False] + n.get((0, True), 0)) > 0.98


def test_no_grades_keep_what_passes_the_base(spark):
    docs = documents(spark)
    none = spark.createDataFrame([(1, None), (None, 1), (2, 0)], "doc_id bigint, quality int")
    for labels in (none, empty(none)):
        assert not quality.fit(docs, labels).emit.any()
