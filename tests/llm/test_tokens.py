"""BPE encoding and decoding, token counts, and packing, against the tokenizer libraries."""

import hashlib
import json
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from cases import TEXTS, documents, empty, plain
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from newslake.llm import bpe, packing, token_counts

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)


@pytest.fixture(scope="module")
def machine():
    with open(WORDS, "rb") as file:
        return bpe.load(file.read())


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def digest(ids):
    return hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text_encodes_as_the_library_does(text):
    encoder, decoder = bpe.load(open(WORDS, "rb").read())
    library = Tokenizer.from_file(WORDS) if not hasattr(test_any_text_encodes_as_the_library_does, "t") else \
        test_any_text_encodes_as_the_library_does.t
    test_any_text_encodes_as_the_library_does.t = library
    ids = ids_of(library, text)
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == ids
    assert "".join(decoder.decode(encoder.stream(text))) == library.decode(ids, skip_special_tokens=False)


def test_long_words_are_streamed(machine, library):
    encoder, _ = machine
    rng = random.Random(4)
    letters = [w.replace("</w>", "") for w in encoder.merges.vocab if w.isascii() and w.replace("</w>", "").isalpha()]
    for _ in range(30):
        word = "".join(rng.choice(letters) for _ in range(rng.choice([300, 700, 2000])))
        assert np.frombuffer(encoder.encode(word), "<u4").tolist() == ids_of(library, word)
    for word in ("a" * 7000, "ab" * 4000, "th" * 3000 + "e", "!" * 6000):
        assert np.frombuffer(encoder.encode(word), "<u4").tolist() == ids_of(library, word)


def test_transducer_holds_a_bounded_window_and_emits_what_is_stable(machine):
    merges = machine[0].merges
    word = ("the" + "ing" * 7 + "x" + "an" * 5) * 3000
    data, stream, out = word.encode(), bpe.Transducer(merges), []
    for k in range(0, len(data), 37):
        out += stream.feed(data[k:k + 37])
        assert len(stream.held) < 2 * merges.window
    assert out, "tokens come before the end"
    short = merges.apply([*[merges.inner[b] for b in data[:4000]]])
    assert out[:100] == short[:100]


def test_lookahead_suffices_for_small_merge_lists():
    """Brute force: tokens that start before the lookahead never change, whatever follows."""
    rng = random.Random(9)
    for _ in range(40):
        tokens, rules = ["a", "b"], []
        while len(rules) < 6:
            left, right = rng.choice(tokens), rng.choice(tokens)
            if left + right not in tokens and len(left + right) <= 6:
                tokens.append(left + right)
                rules.append((left, right))
        number = {t: k for k, t in enumerate(tokens)}
        ranked = [(number[a], number[b], number[a + b]) for a, b in rules]
        reach = bpe.sufficient_lookahead(ranked, [len(t) for t in tokens])

        merges = bpe.Merges.__new__(bpe.Merges)
        merges.rank = {(a, b): k for k, (a, b, _) in enumerate(ranked)}
        merges.product = [c for _, _, c in ranked]

        def tokens_of(text):
            return [tokens[i] for i in merges.apply([number[c] for c in text])]
        for _ in range(30):
            known = "".join(rng.choice("ab") for _ in range(reach + 12))
            stable = set()
            for _ in range(25):
                at, fixed = 0, []
                for token in tokens_of(known + "".join(rng.choice("ab") for _ in range(rng.randrange(9)))):
                    if at >= len(known) - reach:
                        break
                    fixed.append(token)
                    at += len(token)
                stable.add(tuple(fixed))
            assert len(stable) == 1, (rules, known, reach)


def test_byte_level_decoder_gives_text_as_characters_end():
    path = public_tokenizers.path("byte_bpe_50k.json")
    spec, library = json.load(open(path)), Tokenizer.from_file(path)
    decoder = bpe.Decoder(spec)
    for text in ("naïve café 漢字 🙂🙂", "a", "‍🙂"):
        ids = library.encode(text, add_special_tokens=False).ids
        blocks = [np.array([i], "<u4").tobytes() for i in ids]
        assert "".join(decoder.decode(blocks)) == text == library.decode(ids, skip_special_tokens=False)
    cut = library.encode("🙂", add_special_tokens=False).ids[:1]
    assert "".join(decoder.decode([np.array(cut, "<u4").tobytes()])) == library.decode(cut, skip_special_tokens=False)


def test_merge_lists_that_are_out_of_order_are_refused():
    spec = {"model": {"vocab": {c: k for k, c in enumerate(bpe.byte_letters())} | {"ab": 256, "abc": 257},
                      "merges": ["ab c", "a b"]}}
    with pytest.raises(ValueError):
        bpe.Merges(spec)


@pytest.mark.parametrize("clashes", [False, True])
def test_encode_documents(spark, library, clashes):
    docs = documents(spark, with_clashes=clashes)
    got = plain(bpe.encode_documents(docs, WORDS, with_ids=True))
    want = []
    for row in docs.collect():
        ids = ids_of(library, row.text)
        text = library.decode(ids, skip_special_tokens=False)
        want.append((row.doc_id, len(ids), digest(ids), hashlib.sha256(text.encode()).hexdigest(), ids))
    assert got == sorted(want, key=lambda r: tuple((x is not None, x) for x in r))
    assert bpe.encode_documents(empty(docs), WORDS).count() == 0


@pytest.mark.parametrize("clashes", [False, True])
def test_token_counts(spark, clashes):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    docs = documents(spark, [*TEXTS, " lead", "trail ", "  two", "two  ", "a  b   c", "\n a"], clashes)
    got = plain(token_counts.count_tokens(docs, PIECES, limit=4))
    want = [(r.doc_id, len((r.text or "").encode()), n := len(model.encode(r.text or "")), n > 4) for r in docs.collect()]
    assert got == sorted(want, key=lambda r: tuple((x is not None, x) for x in r))
    assert token_counts.count_tokens(empty(docs), PIECES).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab \n▁é漢\x00\t<s>")), max_size=40))
def test_any_text_counts_as_the_library_does(text):
    counter = _counter()
    assert counter.tokens(text) == len(counter.model.encode(text))


def _counter():
    if not hasattr(_counter, "made"):
        _counter.made = token_counts.PieceCounter(open(PIECES, "rb").read())
    return _counter.made


def test_count_in_slices():
    counter = _counter()
    text = "ab  cd e\n" * 500 + "   " + "xyz " * 100
    flat = [t for part in counter.pre_tokens(text, size=50) for t in part]
    assert sum(counter.counts(flat)) == len(counter.model.encode(text)) and "".join(" " + t for t in flat) == " " + text


def test_powers_of_two():
    for n in range(1, 300):
        sizes = packing.lengths_of(n, 64)
        assert sum(sizes) == n and all(s & (s - 1) == 0 for s in sizes) and sizes == sorted(sizes, reverse=True)
        assert len([s for s in sizes if s < 64]) == len({s for s in sizes if s < 64})


@pytest.mark.parametrize("clashes", [False, True])
def test_pack(spark, library, clashes):
    docs = documents(spark, with_clashes=clashes).filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    rows = packing.pack(docs, WORDS, max_length=256, with_ids=True).collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    for doc in docs.collect():
        ids = ids_of(library, doc.text) + [2]
        pieces = sorted((r for r in rows if r.doc_id == doc.doc_id), key=lambda r: r.start)
        assert [i for p in pieces for i in p.ids] == ids
        at = 0
        for p in pieces:
            assert (p.start, p.length, p.doc_tokens, p.offset) == (at, len(p.ids), len(ids), 0)
            assert p.length <= 256 and 1 << p.bucket == p.length
            assert p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes())
            at += p.length


def test_pack_repeats_and_empty(spark, library):
    docs = documents(spark)
    rows = packing.pack(docs, WORDS).collect()
    assert sum(r.length for r in rows) == sum(len(ids_of(library, d.text)) + 1 for d in docs.collect())
    assert packing.pack(empty(docs), WORDS).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, WORDS, max_length=1000)


def test_buckets_are_folders(spark, tmp_path):
    pieces = packing.pack(documents(spark), WORDS, max_length=256)
    packing.write_buckets(pieces, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.filter("bucket = 3").select("length").distinct().collect() == [(8,)]
    assert back.count() == pieces.count()
