"""Registered queries without SQL, by value on a whole table, against the libraries or plain loops."""

import hashlib
import os
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from tokenizers import Tokenizer

from newslake.llm import chat, queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def words():
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    return library


def rows(spark, name, *columns):
    return [tuple(r) for r in queries.all_queries()[name](spark, SF).select(*columns).collect()]


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_bpe(spark, texts, words):
    want = set()
    for doc_id, text in texts.items():
        ids = words.encode(text, add_special_tokens=False).ids
        want.add((doc_id, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(words.decode(ids, skip_special_tokens=False).encode())))
    assert set(rows(spark, "op1_bpe", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")) == want


def test_token_counts(spark, texts):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = {(i, len(t.encode()), n := len(model.encode(t)), n > 4096) for i, t in texts.items()}
    assert set(rows(spark, "op5_token_counts", "doc_id", "n_bytes", "n_tokens", "over_limit")) == want


def test_packing(spark, texts, words):
    found = rows(spark, "op10_packing", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    assert len({r[5] for r in found}) == len(found) and {r[6] for r in found} == {0}
    ids = {i: np.array([*words.encode(t, add_special_tokens=False).ids, 2], "<u4") for i, t in texts.items()}
    ends = dict.fromkeys(ids, 0)
    for doc_id, start, length, crc, total, _, _ in sorted(found):
        assert ends[doc_id] == start and length & (length - 1) == 0 and length <= 4096 and total == len(ids[doc_id])
        assert zlib.crc32(ids[doc_id][start:start + length].tobytes()) == crc
        ends[doc_id] += length
    assert ends == {i: len(v) for i, v in ids.items()}


def fingerprint(text):
    found = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    for c in "\t\n\x0b\x0c\r":
        found = found.replace(c, " ")
    found = [w for w in found.split(" ") if w]
    shingles = [" ".join(found[k:k + 4]) for k in range(max(1, len(found) - 3))] if found else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicates(spark, texts):
    ids = sorted(texts)
    prints = np.array([fingerprint(texts[i]) for i in ids], np.uint64)
    least = np.array(ids)
    for k in range(len(ids)):
        for other in np.unique(least[np.bitwise_count(prints ^ prints[k]) <= 4]):
            low = min(other, least[k])
            least[(least == other) | (least == least[k])] = low
    assert set(rows(spark, "op4_simhash", "doc_id", "fingerprint", "component_id")) == {
        (i, f"{int(p):016x}", int(c)) for i, p, c in zip(ids, prints, least)}


def test_chat_takes_columns_of_any_name(spark):
    turns = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "ho")], "conv_id bigint, turn bigint, role string, text string")
    more = turns.selectExpr("*", *(f"'clash' AS {n}" for n in ("seq", "kind", "message", "event", "mask", "formatted", "learned", "part", "n_turns")))
    want = chat.read_back(chat.format_chat(chat.events_of(turns))).collect()
    assert chat.read_back(chat.format_chat(chat.events_of(more.select("*")))).collect() == want
