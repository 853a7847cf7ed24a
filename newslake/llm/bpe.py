"""BPE encoding as a streaming transducer with bounded lookahead, and decoding as a byte-to-text machine.

A merge list is applied rule by rule. Two texts that agree on a prefix can differ in their tokens only near the
prefix's end: a difference spreads to the left only by a rule whose right part begins with the left part of an
earlier, already different rule. ``sufficient_lookahead`` adds up the longest such chain. A token that starts
further than that from the end of what has been read can therefore never change, and is emitted.
"""

import codecs
import hashlib
import json
import re
import struct
import unicodedata
from itertools import repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from newslake.llm.common import Memo, read_file, slices, worker_state

# White space as the tokenizer's patterns know it, which leaves out four separators of Python's own.
_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_NOT_SPACE = "\x1c\x1d\x1e\x1f"
_SPLIT = re.compile(f"[{_SPACE}]+")


def byte_letters() -> list:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, hidden = {b: chr(b) for b in shown}, 256
    for b in range(256):
        if b not in letters:
            letters[b] = chr(hidden)
            hidden += 1
    return [letters[b] for b in range(256)]


def sufficient_lookahead(rules, lengths) -> int:
    """How many symbols from the end of the text read so far tokens may still change.

    ``rules`` are ``(left, right, product)`` ids by rank, ``lengths`` the symbols of an id. A rule that applies in
    only one of two continuations needs an earlier such rule that starts where its right part does, so the earlier
    rule's left part is the right part or its leftmost part at some depth; the reach adds the new left part.
    """
    first_part, reach, farthest = {}, {}, 0
    for left, right, product in rules:
        before, part = 0, right
        while part is not None:
            before = max(before, reach.get(part, 0))
            part = first_part.get(part)
        far = before + lengths[left]
        reach[left] = max(reach.get(left, 0), far)
        if product in first_part and first_part[product] != left:
            raise ValueError("two rules make one token; its parts are not unique")
        first_part[product] = left
        farthest = max(farthest, far)
    return farthest


class Merges:
    """The rules of a byte-level BPE vocabulary, with or without an end-of-word suffix."""

    def __init__(self, spec: dict):
        model = spec["model"]
        self.vocab = vocab = model["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        letters = byte_letters()
        self.inner = [vocab[c] for c in letters]
        self.last = [vocab[c + suffix] for c in letters] if suffix else self.inner
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        rules = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
        lengths = dict.fromkeys([*self.inner, *self.last], 1)
        for a, b, c in rules:
            if a not in lengths or b not in lengths:
                raise ValueError("a rule uses a token that no earlier rule makes")
            lengths[c] = lengths[a] + lengths[b]
        self.rank = {(a, b): k for k, (a, b, _) in enumerate(rules)}
        self.product = [c for _, _, c in rules]
        self.lengths = lengths
        self.lookahead = sufficient_lookahead(rules, lengths)
        # A window well above the lookahead, so each symbol is worked on about twice at most.
        self.window = max(256, 2 * (self.lookahead + max(lengths.values())))

    def apply(self, ids: list) -> list:
        """All rules on a list of symbols, lowest rank first, from the left."""
        rank, product, none = self.rank.get, self.product, len(self.product)
        ranks = list(map(rank, zip(ids, ids[1:]), repeat(none)))
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            ids[i] = product[best]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank((ids[i - 1], ids[i]), none)
            if i < len(ranks):
                ranks[i] = rank((ids[i], ids[i + 1]), none)
        return ids

    def word(self, data: bytes) -> list:
        """The tokens of one pre-token."""
        if len(data) <= self.window:
            ids = list(map(self.inner.__getitem__, data))
            ids[-1] = self.last[data[-1]]
            return self.apply(ids)
        machine, out = Transducer(self), []
        for start in range(0, len(data), self.window):
            out += machine.feed(data[start:start + self.window])
        return out + machine.finish()


class Transducer:
    """Tokens of one pre-token that arrives in pieces; holds at most a window and the lookahead of it."""

    def __init__(self, merges: Merges):
        self.merges, self.held = merges, b""

    def feed(self, data: bytes) -> list:
        merges, out = self.merges, []
        for start in range(0, len(data), merges.window):
            self.held += data[start:start + merges.window]
            if len(self.held) < merges.window:
                continue
            # The last byte may turn out to end the word, so it is not read yet.
            known = len(self.held) - 1
            stable = known - merges.lookahead
            inner, at = merges.inner, 0
            for token in merges.apply([inner[b] for b in self.held[:known]]):
                if at >= stable:
                    break
                out.append(token)
                at += merges.lengths[token]
            self.held = self.held[at:]
        return out

    def finish(self) -> list:
        data, self.held = self.held, b""
        if not data:
            return []
        merges = self.merges
        return merges.apply([*[merges.inner[b] for b in data[:-1]], merges.last[data[-1]]])


def _packed(ids: list) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Encoder:
    """Texts to ids. Words apart by white space are independent here, so each is a stream of its own."""

    def __init__(self, spec: dict, memo: int = 400_000):
        self.spec, self.library = spec, None
        if json.dumps(spec.get("normalizer")).count('"type"') != 4 or spec.get("post_processor"):
            raise ValueError("only lower-casing vocabularies that drop white space are known here")
        self.merges = Merges(spec)
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace("\\s", _SPACE))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.marks = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        # Both memos hold ids as they are given out: little-endian 32 bits.
        self.pieces = Memo(lambda piece: _packed(self.merges.word(piece.encode())), memo)
        self.words = Memo(self._word, memo)

    def _word(self, word: str) -> bytes:
        if "<|" not in word:
            return self._part(word)
        # Special strings are taken from the raw text, before it is lower-cased.
        parts = enumerate(self.marks.split(word))
        return b"".join(_packed([self.special[part]]) if k % 2 else self._part(part) for k, part in parts if part)

    def _part(self, part: str) -> bytes:
        if not part.isascii():
            # Only unprintable characters can be unknown ones.
            if not part.isprintable() and "Cn" in map(unicodedata.category, part):
                return self._newer(part)
            # Character by character: a sigma at the end of a word is no special case.
            part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
        part, pieces = part.lower(), self.pieces
        # Most words are letters alone, perhaps before a comma or full stop.
        if part.isalpha():
            return pieces[part]
        if part[-1] in ",." and part[:-1].isalpha():
            return pieces[part[:-1]] + pieces[part[-1]]
        return b"".join([pieces[piece] for piece in self.pattern.findall(part)])

    def _newer(self, part: str) -> bytes:
        """Characters that this Python does not know yet are parted and lower-cased by the library's tables."""
        if self.library is None:
            from tokenizers import Tokenizer
            self.library = Tokenizer.from_str(json.dumps(self.spec))
            self.bytes = {c: b for b, c in enumerate(byte_letters())}
        pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(part))
        return b"".join(_packed(self.merges.word(bytes(self.bytes[c] for c in piece))) for piece, _ in pieces)

    def stream(self, text: str):
        """The ids of ``text`` as little-endian 32-bit blocks, one for each slice of it."""
        words = self.words
        for part in slices(text):
            split = [w for w in _SPLIT.split(part) if w] if any(c in part for c in _NOT_SPACE) else part.split()
            yield b"".join(map(words.__getitem__, split))

    def encode(self, text: str) -> bytes:
        return b"".join(self.stream(text))


class Decoder:
    """Ids to text, block by block. State: whether a token came before, and the bytes of an unfinished character."""

    def __init__(self, spec: dict):
        tokens = {**{i: t for t, i in spec["model"]["vocab"].items()}, **{t["id"]: t["content"] for t in spec["added_tokens"]}}
        added = {t["id"] for t in spec["added_tokens"]}
        if spec.get("decoder") is None:
            self.between, make = b" ", lambda i, t: t.encode()
        elif spec["decoder"]["type"] == "ByteLevel":
            back = {c: b for b, c in enumerate(byte_letters())}
            self.between, make = b"", lambda i, t: t.encode() if i in added else bytes(back[c] for c in t)
        else:
            raise ValueError(f"unknown decoder {spec['decoder']['type']}")
        self.table = [make(i, tokens[i]) if i in tokens else b"" for i in range(max(tokens) + 1)]

    def start(self):
        return codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, machine, block: bytes, first: bool) -> str:
        data = self.between.join(map(self.table.__getitem__, np.frombuffer(block, "<u4").tolist()))
        return machine.decode(data if first or not block else self.between + data)

    def decode(self, blocks) -> "iterator of str":
        """The text of ``blocks`` in pieces, as ``decode(ids, skip_special_tokens=False)`` would give it at once."""
        machine, first = self.start(), True
        for block in blocks:
            yield self.feed(machine, block, first)
            first = first and not block
        yield machine.decode(b"", True)


def load(data: bytes, memo: int = 400_000):
    """Encoder and decoder of a tokenizer file, kept for the life of the worker."""
    def make():
        spec = json.loads(data)
        return Encoder(spec, memo), Decoder(spec)
    return worker_state(("bpe", hashlib.md5(data).hexdigest(), memo), make)


def encode_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                     with_ids: bool = False) -> DataFrame:
    """Each text encoded, and decoded again from its ids; one row per row, no shuffle.

    Columns: the id column, ``n_tokens``, ``ids_sha256`` (ids as little-endian 32 bits), ``decoded_sha256``, and
    ``ids`` if asked for. A null text counts as empty: no ids, empty decoded text. Repeated rows are repeated,
    an empty table gives an empty table, other columns of any name are not read. A text of any length is read in
    slices; what is held besides is a window of the longest word and the bounded memo of words seen.
    """
    data = read_file(tokenizer)

    def run(batches):
        encoder, decoder = load(data)
        for batch in batches:
            counts, ids_hash, text_hash, all_ids = [], [], [], []
            for text in batch.column(1):
                ids, decoded, n, kept = hashlib.sha256(), hashlib.sha256(), 0, []

                def blocks():
                    nonlocal n
                    for block in encoder.stream(text.as_py() or ""):
                        ids.update(block)
                        n += len(block) >> 2
                        if with_ids:
                            kept.append(block)
                        yield block
                for piece in decoder.decode(blocks()):
                    decoded.update(piece.encode())
                counts.append(n)
                ids_hash.append(ids.hexdigest())
                text_hash.append(decoded.hexdigest())
                all_ids.append(np.frombuffer(b"".join(kept), "<u4").astype("i4"))
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_hash, pa.string()),
                       pa.array(text_hash, pa.string())]
            names = [batch.schema.names[0], "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(pa.array(all_ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return docs.select(id_col, text_col).mapInArrow(run, schema)
