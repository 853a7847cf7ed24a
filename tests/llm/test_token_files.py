"""Files of token ids with Elias-Fano boundaries: lists against numpy, ids against the tokenizers library."""

import io
import os
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from cases import TEXTS, documents, empty
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from newslake.llm import eliasfano as E
from newslake.llm import queries

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


class Memory(io.BytesIO):
    def size(self):
        return len(self.getvalue())

    def read_at(self, n, at):
        return self.getvalue()[at:at + n]


# ---- rising numbers

@pytest.mark.parametrize("n, top", [(1, 0), (1, 10 ** 12), (2, 1), (511, 9), (512, 10 ** 6), (513, 0), (5000, 70), (5000, 10 ** 9), (3, 2 ** 64 - 1)])
def test_list_gives_its_numbers_back(n, top):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, top, n, np.uint64, endpoint=True))
    values[-1] = top
    found = E.EliasFano.build(values)
    again = E.EliasFano.of(n, found.low_bits, found.parts())
    for one in (found, again):
        assert [one[i] for i in range(0, n, max(1, n // 97))] == values[::max(1, n // 97)].tolist()
        for start, stop in ((0, n), (n // 3, n // 2), (n - 1, n), (n, n), (0, 1)):
            assert one.slice(start, stop).tolist() == values[start:stop].tolist()
    with pytest.raises(IndexError):
        found[n]


def test_list_is_near_its_least_size():
    values = np.cumsum(np.random.default_rng(1).integers(100, 900, 100_000))
    found = E.EliasFano.build(values)
    least = np.log2(values[-1] / len(values)) + 1.44
    assert found.n_bytes() * 8 / len(values) < least + 0.8


def test_list_that_falls_is_refused():
    with pytest.raises(ValueError):
        E.EliasFano.build([1, 0])
    assert E.EliasFano.build([]).slice(0, 0).tolist() == []


# ---- files

@pytest.mark.parametrize("width", [2, 4])
def test_file_gives_documents_back(width):
    rng, sink = random.Random(width), Memory()
    docs = [[rng.randrange(1 << 15) for _ in range(rng.choice([0, 1, 5, 400, 3000]))] for _ in range(300)]
    ids = [None] * 3 + sorted([-2 ** 63, 2 ** 63 - 1, *(rng.randrange(-10 ** 6, 10 ** 6) for _ in range(295))])
    writer = E.IdWriter(sink, width)
    for doc_id, d in zip(ids, docs):
        writer.add(doc_id, [np.array(d[:7], f"<u{width}").tobytes(), np.array(d[7:], f"<u{width}").tobytes()])
    assert writer.close() == (300, sum(map(len, docs)))
    file = E.IdFile(sink)
    assert file.doc_ids(0, 300) == ids and file.doc_ids(2, 5) == ids[2:5]
    assert file.document(17).tolist() == docs[17]
    for start, stop in ((0, 298), (5, 6), (40, 260)):
        for most in (1, 100, 1 << 20):
            got = [(place, length, np.concatenate([np.empty(0, "<u4"), *blocks]).tolist()) for place, length, blocks in file.spans(start, stop, most)]
            assert [g[2] for g in got] == docs[start:stop]
            assert [g[0] for g in got] == np.cumsum([0] + [len(d) for d in docs])[start:stop].tolist()


def test_broken_file_is_refused():
    for data in (b"", b"short", b"x" * 5000):
        with pytest.raises(ValueError):
            E.IdFile(Memory(data))


# ---- texts

def random_texts(n):
    rng = random.Random(5)
    parts = ["a", "Word", "über", " ", " ", "  ", "\n", "\t", "\x1c", "\x85", " ", "​", "don't", "it's", "42", "!", "?!", "<|endoftext|>",
             "日本", "👍🏽", "\x00", "é", "é", "'", "'ll", "\r\n", "\xa0"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(n)]


@pytest.mark.parametrize("path, by_runs", [(BYTES, True), (WORDS, False)])
def test_ids_are_the_librarys(path, by_runs):
    with open(path, "rb") as file:
        found = E.TextIds(file.read(), 500)
    library = Tokenizer.from_file(path)
    assert found.by_runs == by_runs and found.width == 2
    texts = [t or "" for t in TEXTS] + random_texts(3000)
    for text, blocks in zip(texts, E.TextIds(open(path, "rb").read(), 500).encode(texts, 400)):
        assert np.frombuffer(b"".join(blocks), "<u2").tolist() == library.encode(text, add_special_tokens=False).ids
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        for size in (1 << 18, 3):
            assert np.frombuffer(b"".join(found.blocks(text, size)), "<u2").tolist() == want, repr(text)


def brute(rows, path=BYTES, end=0):
    library, start, out = Tokenizer.from_file(path), 0, []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [end]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def laid_out(rows):
    """Starts of a result are gapless in the order of ids."""
    at, last = 0, None
    for doc_id, start, n, _ in sorted(rows, key=lambda r: r[1]):
        assert start == at and (last is None or (doc_id is not None and doc_id >= last))
        at, last = at + n, doc_id
    return sorted(((r[0], r[2], r[3]) for r in rows), key=repr)


@pytest.mark.parametrize("clashes", [False, True])
@pytest.mark.parametrize("options", [{}, {"max_documents": 2}, {"max_ids": 100}])
def test_files_of_edge_cases(spark, clashes, options):
    docs = documents(spark, with_clashes=clashes)
    got = E.token_files(docs, BYTES, **options)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    want = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert laid_out([tuple(r) for r in got.collect()]) == sorted(((r[0], r[2], r[3]) for r in want), key=repr)
    assert E.token_files(empty(docs), BYTES).count() == 0


def test_hot_id_and_spans(spark):
    """A third of all rows has one id; files are read in spans of two documents."""
    rows = [(k if k % 3 else 5, f"text {k % 7} of some words") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    from newslake.session import scratch_path
    files = E.write_ids(docs, BYTES, scratch_path(spark, "ids"), max_documents=20)
    assert files.count() >= 15 and files.agg(F.sum("documents")).first()[0] == 300
    got = E.read_ids(files, step=2, with_ids=True).collect()
    assert laid_out([tuple(r)[:4] for r in got]) == sorted(((r[0], r[2], r[3]) for r in brute(rows)), key=repr)
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and r.ids[-1] == 0 for r in got)


def test_lost_tasks_leave_nothing_that_counts(spark):
    """Files that no row names, as a task that was run again leaves them, are not read."""
    from newslake.session import scratch_path
    folder = scratch_path(spark, "ids")
    docs = spark.createDataFrame([(1, "one"), (2, "two")], "doc_id bigint, text string")
    files = E.write_ids(docs, BYTES, folder)
    with open(os.path.join(folder, "0123.ids"), "wb") as file:
        file.write(b"half a file")
    assert sorted(r.doc_id for r in E.read_ids(E.files_of(spark, folder)).collect()) == [1, 2] and files.count() >= 1


def test_registered_query_equals_the_library(spark):
    sf = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    assert sorted(map(tuple, queries.all_queries()["op12_token_files"](spark, sf).collect())) == brute(rows)


def test_texts_are_cut_together_and_each_run_is_asked_for_once(monkeypatch):
    """A group of texts of many words asks the library for distinct words alone, in one call, and no word is looked up by itself."""
    with open(BYTES, "rb") as file:
        found = E.TextIds(file.read(), 500)
    texts = [" ".join(f"word{k % 40}é  x  y　   z" for k in range(n)) for n in (0, 300, 1, 700)] + random_texts(400)
    asked, real = [], found.encoded
    monkeypatch.setattr(found, "encoded", lambda runs: asked.append(len(runs)) or real(runs))
    looked = []
    monkeypatch.setattr(E.Memo, "__missing__", lambda self, key: looked.append(key))
    library = Tokenizer.from_file(BYTES)
    got = [np.frombuffer(b"".join(blocks), "<u2").tolist() for blocks in found.encode(texts)]
    assert got == [library.encode(text, add_special_tokens=False).ids for text in texts]
    assert len(asked) == 1 and not looked


def test_runs_end_before_signs_and_are_asked_for_together():
    """One word with many signs after it is one distinct run; ids are those of whole texts, special strings included."""
    data = open(BYTES, "rb").read()
    library, texts = Tokenizer.from_file(BYTES), E.TextIds(data, 1000)
    asked = []
    texts.library = type("Counted", (), {"encode_batch_fast": lambda _, batch, **options: asked.extend(batch) or library.encode_batch_fast(batch, **options)})()
    whole = [f" {word}{sign}" for word in ("alpha", "beta") for sign in "!()*+,-./:;=?@[]_{}~"]
    assert [b"".join(found) for found in texts.encode(["".join(whole)])] == [np.array(library.encode("".join(whole)).ids, "<u2").tobytes()]
    assert sum(map(len, asked)) < len("".join(whole)) / 2
    rng = random.Random(5)
    pieces = ["<|endoftext|>", "endoftext", "|", "<|", "|>", "'s", "'", "don't", "x", "12", "3.5", ".", ",", "-", "_", "  ", "\n", "\t ", "\u00a0", "\u2003",
              "\u3000", "\u0301", "\x1c", "\x85", "\u1680", "é", "漢字", "😀", "²", "٣", "a.b@c.d/e?f=g", "\0", " ", " "]
    for size in (2, 5, 20, 300):
        rows = ["".join(rng.choices(pieces, k=size)) for _ in range(400)]
        found = [b"".join(blocks) for blocks in E.TextIds(data, 300).encode(rows, size=2000)]
        assert found == [np.array(library.encode(row, add_special_tokens=False).ids, "<u2").tobytes() for row in rows]


def test_sizes_that_do_not_add_up_are_no_ground_to_part_ids():
    texts = E.TextIds(open(BYTES, "rb").read(), 1000)
    runs = [b" alpha", b" beta", b",", b" ", b" \xc2\xa0"]
    least = [texts.encoded([run.decode()])[0] for run in runs]
    assert texts.encoded_runs(runs) == least
    texts.sizes[:] = 1
    assert texts.encoded_runs(runs) == least
