"""Cuts, resume points and batches against plain loops; every source in the data is one case."""

import random

import pytest
from pyspark.sql import functions as F

from newslake.operators.cut import resume_after, take_until_seen
from newslake.operators.dedup import dedup_any, keep_first
from newslake.operators.ranking import assign_batches, rank_all, top_n

SCHEMA = "source string, category string, pos bigint, id string"
MAX = 4


def loop_until_seen(ids, seen, keep):
    taken = []
    for i in ids:
        if i in taken:
            continue
        if i in seen or len(taken) == MAX:
            return taken
        taken.append(i)
    return taken if keep else []


def loop_resume(ids, last):
    taken, started = [], last is None
    for i in ids:
        if i in taken or i == last:
            started = started or i == last
        elif started:
            taken.append(i)
    return taken


def loop_batches(ids, size, base):
    out, label = [], base
    for at in range(0, len(ids), size):
        chunk = ids[at:at + size]
        label += len(chunk)
        out += [(i, label) for i in chunk]
    return out


FIXED = [
    ("abcde", "c", "c"), ("abcde", "a", "b"), ("abcde", "", "z"), ("aabc", "c", None), ("abcdefgh", "h", "e"),
    ("abcd", "", "d"), ("abcdd", "", None), ("abcdda", "q", "a"), ("", "a", "a"), ("abcdabcde", "e", "c"),
]
_random = random.Random(7)
RANDOM = [
    ("".join(_random.choices("abcdefgh", k=_random.randint(0, 14))), "".join(_random.sample("abcdefghxyz", _random.randint(0, 3))),
     _random.choice([None, "a", "c", "f", "z"])) for _ in range(300)
]
CASES = {(f"s{i}", None if i % 3 == 0 else f"c{i % 3}"): case for i, case in enumerate(FIXED + RANDOM)}


@pytest.fixture(scope="module")
def listing(spark):
    rows = [(*key, pos, i) for key, (ids, _, _) in CASES.items() for pos, i in enumerate(ids)]
    _random.shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(7)


@pytest.fixture(scope="module")
def seen(spark):
    return spark.createDataFrame([(*key, i) for key, (_, ids, _) in CASES.items() for i in ids],
                                 "source string, category string, id string")


def by_key(df, *extra):
    got = {key: [] for key in CASES}
    for row in sorted(df.collect(), key=lambda r: r.pos):
        got[row.source, row.category].append((row.id, *[row[e] for e in extra]) if extra else row.id)
    return got


@pytest.mark.parametrize("mode", ["keep", "drop"])
def test_take_until_seen(listing, seen, mode):
    got = by_key(take_until_seen(listing, seen, MAX, mode))
    assert got == {key: loop_until_seen(ids, known, mode == "keep") for key, (ids, known, _) in CASES.items()}


def test_take_until_seen_takes_a_prefix(listing, seen):
    first = by_key(keep_first(listing))
    for key, taken in by_key(take_until_seen(listing, seen, MAX)).items():
        assert taken == first[key][:len(taken)]


def test_resume_after(spark, listing):
    state = spark.createDataFrame([(*key, last) for key, (_, _, last) in CASES.items() if last],
                                  "source string, category string, last_id string")
    got = by_key(resume_after(listing, state))
    assert got == {key: loop_resume(ids, last) for key, (ids, _, last) in CASES.items()}


@pytest.mark.parametrize("size", [1, 2, 3, 100])
def test_assign_batches(spark, listing, size):
    base = spark.createDataFrame([(*key, 100) for i, key in enumerate(CASES) if i % 2],
                                 "source string, category string, last_batch bigint")
    got = by_key(assign_batches(listing, size, base), "batch_no")
    for i, (key, (ids, _, _)) in enumerate(CASES.items()):
        assert got[key] == loop_batches(ids, size, 100 if i % 2 else 0), key


def test_batches_of_the_fixture(spark):
    rows = spark.createDataFrame([("s", None, i, x) for i, x in enumerate("abcde")], SCHEMA)
    base = spark.createDataFrame([("s", None, 100)], "source string, category string, last_batch bigint")
    assert [b for _, b in sorted((r.pos, r.batch_no) for r in assign_batches(rows, 2, base).collect())] == [102, 102, 104, 104, 105]
    whole = assign_batches(rows, 2, base, remainder="full")
    assert max(r.batch_no for r in whole.collect()) == 106
    by_source = assign_batches(rows, F.when(F.col("source") == "s", 3).otherwise(100), base)
    assert sorted(r.batch_no for r in by_source.collect()) == [103, 103, 103, 105, 105]


def test_bad_options(listing, seen):
    with pytest.raises(ValueError):
        take_until_seen(listing, seen, on_no_match="maybe")
    with pytest.raises(ValueError):
        assign_batches(listing, remainder="none")


def test_hot_source_is_ranked_by_many_tasks(spark):
    """One source with most rows spreads over partitions, and its ranks are still exact."""
    n = 50_000
    rows = spark.range(n).select(
        F.when(F.col("id") % 10 == 0, F.concat(F.lit("s"), F.col("id") % 70)).otherwise("hot").alias("source"),
        (F.col("id") * 7919 % n).alias("pos"))
    ranked = rank_all(rows, ("source",))
    brute = {}
    for r in sorted(rows.collect(), key=lambda r: r.pos):
        brute.setdefault(r.source, []).append(r.pos)
    want = {(s, p): (k + 1, len(ps)) for s, ps in brute.items() for k, p in enumerate(ps)}
    assert {(r.source, r.pos): (r.rn, r.total) for r in ranked.collect()} == want


def test_hot_source_top_n(spark):
    rows = spark.range(20_000).select(F.lit("hot").alias("source"), (F.col("id") * 7919 % 20_000).alias("pos"))
    got = top_n(rows, 500, ("source",)).collect()
    assert sorted((r.rn, r.pos) for r in got) == [(i + 1, i) for i in range(500)]


def test_hot_id_is_merged_before_the_shuffle(spark):
    rows = spark.range(20_000).select(F.lit("s").alias("source"), F.lit(None).cast("string").alias("category"),
                                      F.col("id").alias("pos"), F.lit("same").alias("id"))
    first = keep_first(rows)
    assert [tuple(r) for r in first.collect()] == [("s", None, 0, "same")]
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def test_keep_first_is_idempotent(listing):
    once = keep_first(listing)
    assert sorted(map(str, keep_first(once).collect())) == sorted(map(str, once.collect()))


def test_dedup_any_joins_missing_ids(spark):
    rows = spark.createDataFrame([(None, "a"), (None, "b"), ("x", "c"), ("x", "d")], "id string, title string")
    assert sorted((r.id or "") for r in dedup_any(rows).collect()) == ["", "x"]


def loop_with_rejects(cards, seen, keep):
    """Upper-case cards cannot be taken: what fails comes after the tests for known ids and the limit."""
    taken = []
    for i in cards:
        if i in taken:
            continue
        if i in seen or len(taken) == MAX:
            return taken
        if i.islower():
            taken.append(i)
    return taken if keep else []


@pytest.mark.parametrize("mode", ["keep", "drop"])
def test_rejects_end_a_run_as_the_loop_does(spark, mode):
    rng = random.Random(11)
    fixed = [("abcdX", ""), ("abcd", ""), ("abXcd", ""), ("aXb", "X"), ("abcdd", ""), ("Xabcd", "")]
    cases = {("s%d" % i, None): case for i, case in enumerate(fixed + [
        ("".join(rng.choices("abcdefXYZ", k=rng.randint(0, 9))), "".join(rng.sample("abcdefXYZ", rng.randint(0, 1))))
        for _ in range(200)])}
    rows = [(*key, pos, i) for key, (ids, _) in cases.items() for pos, i in enumerate(ids)]
    every = spark.createDataFrame(rows, SCHEMA)
    seen = spark.createDataFrame([(*key, i) for key, (_, ids) in cases.items() for i in ids],
                                 "source string, category string, id string")
    lower = F.col("id") == F.lower("id")
    out = take_until_seen(every.filter(lower), seen, MAX, mode, rejects=every.filter(~lower))
    got = {key: [] for key in cases}
    for r in sorted(out.collect(), key=lambda r: r.pos):
        got[r.source, r.category].append(r.id)
    assert got == {key: loop_with_rejects(ids, known, mode == "keep") for key, (ids, known) in cases.items()}
