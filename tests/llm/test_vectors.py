"""Hard negatives and clusters against brute force."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from newslake.llm import hard_negatives as H
from newslake.llm import vafile as V

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def table(spark, rows, clashes=False):
    df = spark.createDataFrame(rows, SCHEMA)
    names = "row rb ab dims vector codes aligned place rank v cells hash cluster distance about n total positive_id".split()
    return df.selectExpr("*", *(f"'clash' AS {n}" for n in names)) if clashes else df


def vectors(n, dims, seed, spread=0.1):
    return (np.random.default_rng(seed).standard_normal((n, dims)) * spread).astype(np.float32)


def edge_rows(dims):
    """Nulls, non-finite and repeated values, ties, other lengths, zeros."""
    v = vectors(120, dims, 7)
    rows = [(k, x.tolist(), k % 4) for k, x in enumerate(v)]
    rows += rows[:8] + [(200 + k, rows[k][1], 1) for k in range(12)]
    rows += [(300, None, 1), (301, v[0].tolist(), None), (None, v[1].tolist(), 2), (None, None, None), (302, [], 1),
             (303, [float("nan")] * dims, 1), (304, [float("inf")] + [0.0] * (dims - 1), 1), (350, [0.5] * 3, 1), (351, [0.25] * 3, 1),
             (352, [0.3] * 3, 2), (305, [0.0] * dims, 1), (306, [3e38] * dims, 1), (400, [0.0] * dims, 2), (307, [None] * dims, 1)]
    return rows


# ---- intervals and codes

@pytest.mark.parametrize("dims", [1, 3, 64, 65, 200])
def test_intervals_hold_the_scores(dims):
    whole = np.floor(256 * np.concatenate([vectors(200, dims, dims), vectors(5, dims, 1, 30.0), np.zeros((2, dims))])).astype(np.int64)
    levels = 5
    block = block_of(whole, [0] * len(whole), levels)
    for q in whole[:3].tolist() + whole[-7:].tolist():
        query, exact, seen = H.Query(np.array(q), levels), whole @ np.array(q), []

        def keep(low, high):
            assert (low <= exact).all() and (exact <= high).all()
            seen.append((high - low).mean())
            return np.ones(len(low), bool)
        assert len(block.narrowed(query, np.arange(len(whole)), keep)) == len(whole)
        assert (query.scores(whole) == exact).all()
        assert seen[-1] <= seen[0]


def test_alignment_is_the_product_of_vector_and_code():
    whole = vectors(50, 70, 3).astype(float)
    codes, aligned = H.encode(whole, 1)
    bits = np.unpackbits(codes[:, 0].copy().view(np.uint8), axis=1, bitorder="little")[:, :70]
    unit = (bits * 2.0 - 1) * 70 ** -0.5 @ H.rotation(70, 0)
    assert np.allclose(np.linalg.norm(unit, axis=1), 1) and np.allclose((whole * unit).sum(axis=1), aligned[:, 0])


def test_large_integers_are_scored_exactly():
    top = H.largest_component(64)
    whole = np.full((2, 64), top, np.int64)
    assert H.Query(whole[0], 1).scores(whole).tolist() == [64 * top * top] * 2
    assert 64 * top * top < 2 ** 63


def block_of(whole, labels, levels):
    import pyarrow as pa
    codes, aligned = H.encode(whole, levels)
    return H.Block(pa.table({
        "vec_id": pa.array(range(len(whole)), pa.int64()), "label": pa.array(labels, pa.int64()),
        **{n: pa.array([x.tobytes() for x in a], pa.binary()) for n, a in (("vector", whole), ("codes", codes), ("aligned", aligned))}}), levels)


def test_intervals_spare_most_scores():
    whole = np.floor(256 * (v := vectors(4000, 64, 5)) / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.int64)
    block = block_of(whole, np.arange(4000) % 10, 6)
    query = H.Query(whole[0], 6)
    (rows, scores), scored = H.positives_in(block, query, 0, 0, 5)
    assert scored < 400 / 2
    found, scored = H.negatives_in(block, query, 0, [(s * 50 // 100, s * 95 // 100) for s in scores.tolist()], 3)
    assert scored < 3600 / 5 and all(len(f[0]) == 3 for f in found)


# ---- the job

def brute_negatives(rows, anchors, scale=256, n_positives=5, n_negatives=3, low=50, high=95):
    kept = []
    for vec_id, v, label in rows:
        if label is None or not v or any(x is None or not np.isfinite(x) for x in v):
            continue
        whole = [int(np.floor(scale * float(np.float32(x)))) for x in v]
        if max(map(abs, whole)) <= H.largest_component(len(v)):
            kept.append((vec_id, whole, label))
    last = lambda i: (i is None, i or 0)
    out = []
    for anchor, q, label in kept:
        if anchor is None or not anchors(anchor):
            continue
        scored = [(sum(a * b for a, b in zip(q, v)), i, other) for i, v, other in kept if len(v) == len(q)]
        same = sorted(((s, i) for s, i, other in scored if other == label and i != anchor), key=lambda x: (-x[0], last(x[1])))
        for ps, pid in same[:n_positives]:
            fit = sorted(((s, i) for s, i, other in scored if other != label and low * ps <= 100 * s <= high * ps),
                         key=lambda x: (-x[0], last(x[1])))
            out += [(anchor, pid, k + 1, i, ps, s) for k, (s, i) in enumerate(fit[:n_negatives])]
    return sorted(out, key=repr)


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


@pytest.mark.parametrize("dims, clashes, blocks", [(64, False, 16_384), (5, True, 16), (130, False, 40)])
def test_hard_negatives_equal_brute_force(spark, dims, clashes, blocks):
    rows = edge_rows(dims)
    got = H.mine(table(spark, rows, clashes), "vec_id % 10 = 0", block_rows=blocks, block_anchors=8, least_blocks=2)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=repr) == brute_negatives(rows, lambda i: i % 10 == 0)


def test_hot_vector_and_label(spark):
    """A third of all rows is one vector, and nearly all rows have one label."""
    v = vectors(200, 8, 11)
    rows = [(k, v[0 if k % 3 == 0 else k].tolist(), 1 if k % 50 else 2) for k in range(200)]
    got = H.mine(table(spark, rows), "vec_id % 20 = 0", block_rows=32, least_blocks=1)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_negatives(rows, lambda i: i % 20 == 0)


def test_no_rows_no_anchors(spark):
    for rows in ([], [(1, [0.5], 1), (3, [0.5], 2)], [(300, None, 1)]):
        got = H.mine(table(spark, rows))
        assert got.columns == COLUMNS and got.count() == 0


# ---- clusters

def brute_clusters(rows, k=16, rounds=3, dims=64, scale=64, seed=1):
    kept = []
    for vec_id, v, _ in rows:
        if v is not None and len(v) == dims and all(x is not None and abs(x * scale) <= V.LARGEST for x in v):
            kept.append((vec_id, [int(np.floor(scale * float(np.float32(x)))) for x in v]))
    key = lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(kept, key=key)[:k]]

    def assigned():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centroids)) for _, v in kept]
    for _ in range(rounds):
        of = [c for _, c in assigned()]
        for c in set(of):
            mine = [v for (_, v), o in zip(kept, of) if o == c]
            centroids[c] = [sum(x) // len(mine) for x in zip(*mine)]
    last = assigned()
    inertia = [sum(d for d, o in last if o == c) for c in range(len(centroids))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, inertia[c], sum(inertia), digest[c]) for (i, _), (d, c) in zip(kept, last)), key=repr)


@pytest.mark.parametrize("dims, k, bits, sample, clashes", [(64, 16, 6, 4096, False), (5, 3, 2, 10, True), (9, 1, 1, 1, False), (64, 400, 4, 20, False)])
def test_clusters_equal_brute_force(spark, dims, k, bits, sample, clashes):
    rows = edge_rows(dims)
    got = V.cluster(table(spark, rows, clashes), k, dims=dims, bits=bits, sample=sample)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_clusters(rows, k, dims=dims)


def test_all_vectors_equal(spark):
    rows = [(k, [0.5] * 64, 0) for k in range(40)]
    assert sorted(map(tuple, V.cluster(table(spark, rows)).collect()), key=repr) == brute_clusters(rows)


def test_no_vectors(spark):
    for rows in ([], [(1, [0.5], 1), (2, None, 1)]):
        assert V.cluster(table(spark, rows)).count() == 0


@pytest.mark.parametrize("bits", [1, 4, 6, 8])
def test_cells_give_bounds_and_spare_fetches(bits):
    whole = np.floor(64 * vectors(3000, 64, 2)).astype(np.int64)
    cells = V.Cells(whole[:500], whole.min(axis=0), whole.max(axis=0), bits)
    codes = cells.decode(cells.encode(whole)).astype(int)
    assert codes.max() < 1 << bits
    dims = np.arange(64)
    assert (cells.edges[dims, codes] <= whole).all() and (whole < cells.edges[dims, codes + 1]).all()
    centroids = whole[:16]
    for c in centroids:
        nearest, farthest = cells.tables(c)
        exact = ((whole - c) ** 2).sum(axis=1)
        assert (nearest[dims, codes].sum(axis=1) <= exact).all() and (exact <= farthest[dims, codes].sum(axis=1)).all()
    fetched = []
    assigner = V.Assigner(cells, centroids)
    found = assigner.assign(cells.encode(whole), lambda rows: (fetched.append(rows), whole[rows])[1])
    assert (found == ((whole[:, None] - centroids) ** 2).sum(axis=2).argmin(axis=1)).all()
    assert assigner.fetched == sum(map(len, fetched)) and (bits < 6 or assigner.fetched < 1000)


def test_registered_queries_count_whole_tables(spark):
    from newslake.llm import queries
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = queries.all_queries()["op13_clusters"](spark, "/root/testdata/sf0.001")
    assert sorted(map(tuple, got.collect()), key=repr) == brute_clusters(rows)
    rows = [(i, v, (label + 1) % 10 if i % 7 == 0 else label) for i, v, label in rows]
    got = queries.all_queries()["op11_hard_negatives"](spark, "/root/testdata/sf0.001")
    assert sorted(map(tuple, got.select(*COLUMNS).collect()), key=repr) == brute_negatives(rows, lambda i: i % 50 == 0)
    assert got.filter(F.col("rank") > 3).count() == 0
