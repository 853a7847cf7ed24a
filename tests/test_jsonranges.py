"""Large JSON files by byte ranges, against the reader of whole texts, with ranges of a few bytes."""

import json
import random

import pytest
from pyspark.sql import functions as F

from newslake.sources import jsonranges as J
from newslake.sources.articles import read_files
from newslake.sources.jsontext import objects, values


def random_value(rng, depth=0):
    strings = ["", "a", "}", "{", '"', "\\", "\\\\", "]}", "[{", "é日👍", "\n", 'x"}y', "\t", " ", ","]
    kind = rng.random()
    if kind < 0.5 or depth > 3:
        return "".join(rng.choice(strings) for _ in range(rng.randrange(6)))
    if kind < 0.7:
        return [random_value(rng, depth + 1) for _ in range(rng.randrange(3))]
    if kind < 0.9:
        return {random_value(rng, 9) or "k": random_value(rng, depth + 1) for _ in range(rng.randrange(3))}
    return rng.choice([1, -2.5e3, True, None])


def random_file(rng):
    rows = [{"id": f"i{k}", "content": random_value(rng, 9), "more": random_value(rng)} for k in range(rng.randrange(0, 7))]
    indent = rng.choice([None, None, 1, 4])
    shape = rng.random()
    if shape < 0.5:
        out = json.dumps(rows, indent=indent, ensure_ascii=rng.random() < 0.5)
    elif shape < 0.8:
        out = rng.choice(["\n", "", " \r\n\t"]).join(json.dumps(r, indent=indent) for r in rows)
    else:
        out = json.dumps(random_value(rng))
    if rng.random() < 0.1:
        out = "﻿" + out
    if rng.random() < 0.2:
        out = rng.choice(["\n", " "]) + out + rng.choice(["\n", "  ", ""])
    if rng.random() < 0.25:
        at = rng.randrange(len(out) + 1)
        out = rng.choice([out[:at], out + rng.choice(["}", "]", ",", "{", '"', "x", "17", "[]", "{}"]), out[:at] + rng.choice('}{"[],') + out[at:]])
    return out


def by_ranges(text: str, sizes):
    """The passes without Spark: pieces of a text dealt to ranges as a reader does it."""
    data = text.encode()
    data = data[3:] if data.startswith(b"\xef\xbb\xbf") else data
    pieces = data.split(b"}")
    pieces = pieces[:-1] if pieces[-1] == b"" else pieces
    ranges, k = [], 0
    while k < len(pieces):
        n = next(sizes)
        ranges.append([p.decode() for p in pieces[k:k + n]])
        k += n
    rows = []
    for start, part in enumerate(ranges):
        summary = J.Summary()
        for p in part:
            summary.add(p, len(p.encode()))
        rows.append({"path": "f", "start": start, "size": len(text.encode()), "octets": summary.octets, "first": summary.first,
                     "broken": summary.broken, "ends": summary.states, "changes": summary.depths, "closings": [list(c.items()) for c in summary.closings]})
    starts = J.compose(rows)
    if starts[0]["problem"]:
        return None
    found, parts = {}, {}
    for start, part in zip(starts, ranges):
        records = J.Records(int(start["inside"]), start["depth"], start["pos"], start["base"], start["start"] == 0)
        for k, p in enumerate(part):
            done = records.feed(p, k < len(part) - 1 or start["brace"])
            if records.problem:
                return None
            if done:
                (found if done[1] else parts).setdefault(records.pos - 1, []).append(done[0])
        if records.held:
            parts.setdefault(records.pos, []).append("".join(records.held))
    found.update({pos: ["".join(v)] for pos, v in parts.items()})
    found = [found[pos] for pos in range(len(found))]
    if any(len(v) != 1 or J._check(v[0]) for v in found):
        return None
    return [json.loads(v[0]) for v in found]


def whole(text: str):
    kind, array, _ = values(text)
    return None if kind is None else json.loads(array)


def test_ranges_of_any_size_give_what_whole_texts_give():
    rng = random.Random(3)
    taken = 0
    for _ in range(20_000):
        text = random_file(rng)
        want = whole(text)
        if not text.strip("﻿ \t\r\n"):
            continue
        sizes = iter(lambda: rng.choice([1, 1, 2, 5]), None)
        assert by_ranges(text, sizes) == want, text
        taken += want is not None
    assert taken > 10_000


@pytest.fixture
def small_ranges(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_files_by_ranges(spark, tmp_path, small_ranges):
    rng, want, bad = random.Random(8), {}, set()
    for k in range(14):
        text = "".join(random_file(rng)) if k % 3 else json.dumps(
            [{"id": f"r{i}", "content": "} \" { " * rng.randrange(60), "title": "é"} for i in range(rng.randrange(40))], indent=rng.choice([None, 2]))
        if not text.strip("﻿ \t\r\n"):
            continue
        (tmp_path / f"a b+{k}.json").write_text(text, encoding="utf-8")
        rows = whole(text)
        if rows is None:
            bad.add(f"a b+{k}.json")
        else:
            want.update({(f"a b+{k}.json", i): r["id"] if isinstance(r.get("id"), str) else None for i, r in enumerate(rows)})
    root = str(tmp_path)
    assert J._pieces(spark, root).select("start").distinct().count() > 8
    for below in (0, 1000):
        rows, rejects = read_files(spark, root, "id string", whole_below=below)
        got = {(r.path.rsplit("/", 1)[1], r.pos): r.id for r in rows.collect()}
        assert {k: v for k, v in got.items() if want.get(k) is not None} == {k: v for k, v in want.items() if v is not None}
        assert set(got) == set(want)
        assert {r.path.rsplit("/", 1)[1] for r in rejects.collect()} == bad


def test_one_file_is_read_by_several_tasks(spark, tmp_path, small_ranges):
    rows = [{"id": f"i{k}", "content": "word } " * 20} for k in range(200)]
    (tmp_path / "x.json").write_text(json.dumps(rows))
    (tmp_path / "cut.json").write_text(json.dumps(rows)[:-1])
    pieces = J._pieces(spark, str(tmp_path / "x.json"))
    assert pieces.select(F.spark_partition_id()).distinct().count() > 10
    rows, rejects = J.read_records(spark, str(tmp_path))
    assert [json.loads(r.value)["id"] for r in rows.orderBy("pos").collect()] == [f"i{k}" for k in range(200)]
    assert [(r.path.rsplit("/", 1)[1], r.problem) for r in rejects.collect()] == [("cut.json", "broken JSON")]


def test_texts_in_chunks_equal_the_reader_of_whole_texts():
    rng = random.Random(11)
    texts = ["", " ", "﻿", "[]", "[{}]{}", "{}[]", "{} 1", "[1]", "[{},]", "[{}", "{", "12", "[{}] x", "[[]]", '[{"a": "' + "x" * 90]
    for text in [*texts, *(random_file(rng) for _ in range(4000))]:
        chunks = [text[i:i + n] for n in [rng.choice([1, 3, 40, 4000])] for i in range(0, len(text), n)]
        found, got = objects(chunks), []
        while True:
            try:
                got.append(next(found))
            except StopIteration as end:
                kind, problem = end.value
                break
        want_kind, want, want_problem = values(text)
        assert (kind, problem) == (want_kind, want_problem), repr(text)
        if want is not None:
            assert json.loads(f"[{','.join(got)}]") == json.loads(want), repr(text)
