"""Memory and time of single tasks on inputs made to strain them."""

import time
import tracemalloc

import numpy as np
import xxhash

from newslake.llm import exact, simhash, toxicity


def test_short_contents_stay_below_the_memory_named():
    contents = (f"{k:08d}".encode() for k in range(60_000))
    memory, peak = 4 << 20, 0
    tracemalloc.start()
    total = 0
    for table in exact.grace(((xxhash.xxh3_64_intdigest(c), c, None) for c in contents), lambda value, _: (1, None, 2), memory):
        peak = max(peak, tracemalloc.get_traced_memory()[0])
        total += len(table.values)
    tracemalloc.stop()
    assert total == 60_000 and peak < 1.3 * memory


def test_members_of_a_group_are_not_gathered():
    import pyarrow as pa
    rows = pa.RecordBatch.from_pydict({"id": pa.array(range(100_000), pa.int64()), "text": pa.array(["same"] * 100_000)})

    class Context:
        @staticmethod
        def get():
            return Context()

        def partitionId(self):  # noqa: N802
            return 3
    real, exact.TaskContext = exact.TaskContext, Context
    try:
        sizes = [len(out) for out in exact._local(48 << 20)(iter([rows]))]
    finally:
        exact.TaskContext = real
    assert sum(sizes) == 100_001 and max(sizes) <= exact._OUT


def test_a_megabyte_of_excused_hits_takes_linear_time():
    lexicon = toxicity.Lexicon({" trash ": 1.0, " damn ": 2.0}, ["trash can", "damn good"])
    machine, seconds = lexicon.automaton(), []
    for n in (20_000, 80_000):
        words = "trash can damn".split() * n
        started = time.perf_counter()
        assert len(lexicon.hits(machine, words)) == n
        seconds.append(time.perf_counter() - started)
    assert seconds[1] < 12 * seconds[0] and seconds[1] < 10


def test_excused_hits_equal_every_pair_compared():
    rng = np.random.default_rng(4)
    lexicon = toxicity.Lexicon({" a ": 1.0, " b ": 2.0, " ab": 3.0}, ["a b", "b b a", "c a"])
    machine = lexicon.automaton()
    for _ in range(300):
        words = rng.choice(["a", "b", "c", "abc"], 30).tolist()
        found = [(end - size + 1, end, weight) for end, (size, weight) in machine.iter(f" {' '.join(words)} ")]
        spans = [(x, y) for x, y, weight in found if weight is None]
        want = [(x, w) for x, _, w in found if w is not None and not any(p <= x and x + 1 < q for p, q in spans)]
        assert lexicon.hits(machine, words) == want


def components(points, linker):
    label = linker.label
    return {frozenset(points[label == x].tolist()) for x in np.unique(label)}


def brute(points, bits=4):
    root = np.arange(len(points))
    for k in range(len(points)):
        near = np.flatnonzero(np.bitwise_count(points ^ points[k]) <= bits)
        low = root[near].min()
        for other in np.unique(root[near]):
            root[root == other] = low
    return {frozenset(points[root == x].tolist()) for x in np.unique(root)}


def test_points_equal_in_a_block_are_linked_without_comparing_all():
    masks, radius = simhash.blocks_of(4, 3)
    rng = np.random.default_rng(9)
    for mask in masks:
        for n, flips in ((3000, 5), (1200, 2)):
            points = rng.integers(0, 2 ** 64, n, dtype=np.uint64)
            near = points[:400].copy()
            for _ in range(flips):
                near ^= np.uint64(1) << rng.integers(0, 64, 400).astype(np.uint64)
            points = np.unique(np.concatenate([points, near]) & ~mask | np.uint64(0x5555555555555555) & mask)
            linker = simhash.Linker(points, mask, radius, 4)
            linker.own(np.arange(len(points)))
            assert components(points, linker) == brute(points)
    points = np.unique(rng.integers(0, 2 ** 64, 60_000, dtype=np.uint64) & ~masks[0])
    started = time.perf_counter()
    simhash.Linker(points, masks[0], radius, 4).own(np.arange(len(points)))
    assert time.perf_counter() - started < 60


def test_a_family_that_no_bits_part_is_linked():
    rng = np.random.default_rng(3)
    masks, radius = simhash.blocks_of(4, 3)
    points = np.unique(np.bitwise_xor.reduce(np.uint64(1) << rng.integers(0, 64, (3, 4000)).astype(np.uint64), axis=0))
    linker = simhash.Linker(points, masks[0], radius, 4)
    linker.own(np.arange(len(points)))
    # Within one tree all pairs that differ little in its block are linked; here that is nearly one component.
    assert len(components(points, linker)) < len(points) / 10
