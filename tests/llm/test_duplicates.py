"""Exact and near duplicates against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from cases import LONG, TEXTS, documents, empty, plain

from newslake.llm import components, exact, simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sort_key(row):
    return tuple((x is not None, x) for x in row)


# ---- exact

def brute_exact(rows):
    groups = collections.defaultdict(list)
    for row in rows:
        groups["".join(WORD.findall(row.text or ""))].append(row)
    out = []
    for text, members in groups.items():
        best = min(members, key=lambda r: (-len(r.text or ""), r.doc_id is None, r.doc_id or 0))
        left = 1
        for r in members:
            kept = r.doc_id == best.doc_id and len(r.text or "") == len(best.text or "") and left
            left -= bool(kept)
            out.append((r.doc_id, best.doc_id, len(members), bool(kept), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=sort_key)


@pytest.mark.parametrize("memory", [48 << 20, 300])
@pytest.mark.parametrize("clashes", [False, True])
def test_exact_duplicates(spark, memory, clashes):
    docs = documents(spark, [*TEXTS, "ab", "a b", "a  b", "a\tb ", LONG + " ", "b a"], clashes).repartition(3)
    assert plain(exact.exact_duplicates(docs, memory=memory)) == brute_exact(docs.collect())


def test_exact_on_nothing(spark):
    docs = empty(documents(spark))
    assert exact.exact_duplicates(docs).count() == 0 and exact.keep_one(docs).count() == 0


def test_hot_text_is_one_record_for_each_task(spark):
    rng = random.Random(3)
    texts = ["hot text"] * 600 + [f"own {rng.random()}" for _ in range(900)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(6)
    got = exact.exact_duplicates(docs).collect()
    assert sum(r.kept for r in got) == 901
    assert {(r.keep_id, r.group_size) for r in got if r.doc_id < 600} == {(0, 600)}


@pytest.mark.parametrize("clashes", [False, True])
def test_keep_one_keeps_rows_whole(spark, clashes):
    docs = documents(spark, [*TEXTS, "a b", "ab", "ab"], clashes)
    docs = docs.unionByName(docs.limit(6))
    kept = exact.keep_one(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    texts = ["".join(WORD.findall(r.text or "")) for r in rows]
    assert len(texts) == len(set(texts)) == len({"".join(WORD.findall(r.text or "")) for r in docs.collect()})
    assert set(rows) <= set(docs.collect())


def test_table_compares_contents_of_equal_hashes():
    table = exact.ContentTable()
    slots = [table.find(7, f"text {k}".encode(), [k]) for k in range(2000)]
    assert [s[0] for s in slots] == list(range(2000))
    assert table.find(7, b"text 1234", None) is slots[1234]


def test_grace_spills_and_cleans_up(tmp_path, monkeypatch):
    monkeypatch.setattr(exact.tempfile, "tempdir", str(tmp_path))
    rng = random.Random(1)
    contents = [str(rng.randrange(3000)).encode() * 9 for _ in range(9000)]
    records = [(xxhash.xxh3_64_intdigest(c), c, 1) for c in contents]
    seen, files = collections.Counter(), 0
    for table in exact.grace(iter(records), lambda value, n: (value or 0) + n, memory=2000):
        files = max(files, len(list(tmp_path.rglob("*"))))
        assert table.size < 2000 + 600
        for content, (count,) in zip(table.contents, table.values):
            assert content not in seen
            seen[content] = count
    assert seen == collections.Counter(contents) and files > 10
    assert not list(tmp_path.iterdir())


# ---- near

def brute_print(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[k:k + 4]) for k in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, bits=4):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    points = np.array(prints, "<u8")
    for k in range(len(points)):
        for j in np.flatnonzero(np.bitwise_count(points ^ points[k]) <= bits):
            a, b = sorted((find(k), find(int(j))))
            root[b] = a
    return [find(k) for k in range(len(points))]


def brute_near(rows):
    prints = [brute_print(r.text) for r in rows]
    roots, least = brute_components(prints), {}
    for root, row in zip(roots, rows):
        if row.doc_id is not None:
            least[root] = min(least.get(root, row.doc_id), row.doc_id)
    return sorted(((r.doc_id, f"{p:016x}", least.get(x)) for r, p, x in zip(rows, prints, roots)), key=sort_key)


def edited(rng, text, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(50)}"
    return " ".join(words)


@pytest.mark.parametrize("clashes", [False, True])
def test_near_duplicates(spark, clashes):
    rng = random.Random(8)
    bases = [" ".join(f"w{rng.randrange(400)}" for _ in range(200)) for _ in range(30)]
    texts = [*TEXTS[:13], *bases, *(edited(rng, b, rng.randrange(1, 4)) for b in bases for _ in range(5)), LONG, LONG + " x"]
    docs = documents(spark, texts, clashes)
    rows = docs.collect()
    got = plain(simhash.near_duplicates(docs))
    assert got == brute_near(rows)
    assert len({c for _, _, c in got}) < len(rows) - 60
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({c for i, _, c in got if c is not None})


def test_near_on_nothing(spark):
    docs = empty(documents(spark))
    assert simhash.near_duplicates(docs).count() == 0 and simhash.keep_one(docs).count() == 0


def family(rng, centre, n, flips):
    points = np.full(n, centre, np.uint64)
    for _ in range(flips):
        points ^= np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)
    return points


@pytest.mark.parametrize("shard,bits,blocks", [(100, 4, 3), (1 << 16, 4, 3), (200, 4, 5), (150, 6, 2)])
def test_links_connect_what_all_pairs_connect(spark, shard, bits, blocks):
    """Random points with families about them, over several depths of the shared levels."""
    rng = np.random.default_rng(shard + bits)
    points = rng.integers(0, 1 << 64, 1500, dtype=np.uint64)
    points = np.unique(np.concatenate([points, *(family(rng, c, 40, bits) for c in points[:12])]))
    frame = spark.createDataFrame([(int(p),) for p in points.view("<i8")], "fp bigint")
    links = simhash.near_links(frame, bits, blocks, shard)
    roots = {r.node: r.root for r in components.connected(links).collect()}
    signed = points.view("<i8").tolist()
    want = brute_components(points, bits)
    mine = collections.defaultdict(set)
    for p, w in zip(signed, want):
        mine[w].add(p)
    got = collections.defaultdict(set)
    for p in signed:
        got[roots.get(p, p)].add(p)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, got.values()))


def test_points_that_nothing_parts():
    """A dense family shares all bits of a block; its links are found without all pairs."""
    rng = np.random.default_rng(2)
    points = np.unique(np.concatenate([family(rng, rng.integers(0, 1 << 64, dtype=np.uint64), 3000, 3) & ~np.uint64(0x1FFFFF),
                                       np.uint64(1) << np.arange(21, 60, dtype=np.uint64)]))
    masks, radius = simhash.blocks_of(4, 3)
    linker = simhash.Linker(points, masks[0], radius, 4)
    linker.own(np.arange(len(points)))
    _, want = np.unique(brute_components(points), return_inverse=True)
    _, got = np.unique(linker.label, return_inverse=True)
    assert (want == got).all()


def test_components(spark):
    rng = random.Random(5)
    pairs = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (300, 301), (301, 300)]
    rng.shuffle(pairs)
    got = {r.node: r.root for r in components.connected(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert got == {**{k: 1 for k in range(1, 41)}, **{k: 100 for k in range(100, 160)}, 300: 300, 301: 300}
    assert components.connected(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
