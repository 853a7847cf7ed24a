"""Chat formatting from event logs: fold what happened to each message, then render the conversation.

A log has events of messages: ``open`` (with the role), ``delta`` (text that is appended), ``edit`` (the text is
replaced) and ``regenerate`` (the text so far is thrown away, streaming begins anew). Logs are dealt out by conversation
and sorted by message and sequence; a fold that holds one message at a time turns them into messages and renders them.
"""

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.llm import common  # noqa: F401  ships this package with its tasks

# The template. Assistant turns end with a closing sign that the model learns to write; other turns are instructions.
_OPEN, _CLOSE, _TURN, _END = "[INST] ", " [/INST]", "<s>", "</s>"
_CONTROL = re.compile(r"\\|</?s>|\[/?INST\]")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
ASSISTANT = "assistant"


def escape(text: str) -> str:
    """No control string of the template is left: each gets a backslash after its first sign, as do backslashes."""
    return _CONTROL.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(role: str, text: str):
    """A turn, and where in it the text under the loss mask begins and ends."""
    head = _TURN + escape(role).replace("\n", "\\n") + "\n"
    body = escape(text)
    if role == ASSISTANT:
        return f"{head}{body}{_END}", len(head), len(head) + len(body)
    return f"{head}{_OPEN}{body}{_CLOSE}", 0, 0


def parse(turn: str):
    """Role and text of a rendered turn."""
    if not turn.startswith(_TURN):
        raise ValueError("a turn begins with its mark")
    role, _, rest = turn[len(_TURN):].partition("\n")
    # A line break in a role is written as a backslash and n, which the escapes of control strings never are.
    role = _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], role)
    if rest.startswith(_OPEN) and rest.endswith(_CLOSE):
        return role, unescape(rest[len(_OPEN):-len(_CLOSE)])
    if not rest.endswith(_END):
        raise ValueError("a turn ends with its mark")
    return role, unescape(rest[:-len(_END)])


def events_of(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A finished table of turns as the log of how it came to be: ``conv_id, turn, message, seq, kind, value``.

    Assistant texts are streamed in two halves after a draft that was thrown away, others are typed and then edited.
    ``message`` tells rows of one turn apart; they follow one another by role and the hash of their text.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    half = F.floor(F.length(value) / 2).cast("int")
    first, second = F.substring(value, F.lit(1), half), F.substring(value, half + 1, F.length(value))

    def event(seq: int, kind: str, content: Column) -> Column:
        return F.struct(F.lit(seq).alias("seq"), F.lit(kind).alias("kind"), content.alias("value"))

    who = F.coalesce(F.col(role), F.lit(""))
    streamed = F.array(event(0, "open", who), event(1, "delta", first), event(2, "regenerate", F.lit("")),
                       event(3, "delta", first), event(4, "delta", second))
    typed = F.array(event(0, "open", who), event(1, "delta", first), event(2, "edit", value))
    message = F.concat_ws(" ", who, F.xxhash64(value).cast("string"), F.monotonically_increasing_id().cast("string"))
    # The number of a row is given before its events are unrolled.
    logged = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), message.alias("message"),
                          F.when(who == ASSISTANT, streamed).otherwise(typed).alias("events"))
    return logged.select("conv_id", "turn", "message", F.explode("events").alias("e")).select("conv_id", "turn", "message", "e.*")


class Fold:
    """One message as its events arrive."""

    def __init__(self):
        self.role, self.parts = "", []

    def apply(self, kind, value):
        value = value or ""
        if kind == "open":
            self.role = value
        elif kind == "delta":
            self.parts.append(value)
        elif kind == "edit":
            self.parts = [value]
        elif kind == "regenerate":
            self.parts = []
        else:
            raise ValueError(f"unknown event {kind!r}")

    @property
    def text(self):
        return "".join(self.parts)


_ROWS, _BYTES = 2_000, 8 << 20


def format_chat(events: DataFrame) -> DataFrame:
    """Rendered turns of all conversations: ``conv_id, place, rendered, at, loss_start, loss_end``.

    A conversation's turns follow one another in one partition, numbered by ``place`` from 0; ``at`` is where a turn
    begins in the conversation's text, which is all turns in a row. The loss mask is ``[loss_start, loss_end)`` within
    ``rendered``, empty but for assistant turns. A null role or value counts as empty, null conversations are one
    conversation, null turns come first. Repeated events count twice. No events, no rows. A conversation of any length
    passes through one task as a sorted stream, since its turns are one text; one message of it is held at a time.
    """
    kind = events.schema["conv_id"].dataType.simpleString()
    ids = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()

    def run(batches):
        fold, message, conv, place, at, rows, size = None, None, None, 0, 0, [], 0

        def batch_of(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (ids, pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()))],
                ["conv_id", "place", "rendered", "at", "loss_start", "loss_end"])

        def done():
            nonlocal place, at, size
            rendered, start, end = render(fold.role, fold.text)
            rows.append((conv, place, rendered, at, start, end))
            place, at, size = place + 1, at + len(rendered), size + len(rendered)

        for batch in batches:
            for c, t, m, k, v in zip(*(batch.column(n).to_pylist() for n in range(5))):
                if fold is None or (c, t, m) != message:
                    if fold is not None:
                        done()
                        if len(rows) >= _ROWS or size >= _BYTES:
                            yield batch_of(rows)
                            rows, size = [], 0
                    if fold is None or c != conv:
                        conv, place, at = c, 0, 0
                    fold, message = Fold(), (c, t, m)
                fold.apply(k, v)
        if fold is not None:
            done()
        if rows:
            yield batch_of(rows)

    ordered = events.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "message", "seq")
    return ordered.select("conv_id", "turn", "message", "kind", "value").mapInArrow(
        run, f"conv_id {kind}, place bigint, rendered string, at bigint, loss_start bigint, loss_end bigint")


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the formatted text says, one row per conversation, by parsing it.

    ``formatted`` is as ``format_chat`` gives it, a conversation's turns in order in one partition. Columns: ``conv_id,
    n_turns, turns_sha256`` (of role, newline, text, newline per turn), ``loss_chars, loss_sha256`` (text under the loss
    mask, unescaped), ``formatted_chars``.
    """
    kind = formatted.schema["conv_id"].dataType.simpleString()
    ids = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()

    def run(batches):
        state, conv, out = None, None, []

        def new():
            return [0, hashlib.sha256(), 0, hashlib.sha256(), 0]

        def row():
            n, turns, chars, loss, size = state
            return conv, n, turns.hexdigest(), chars, loss.hexdigest(), size

        def batch_of(rows):
            types = (ids, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), types)],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for batch in batches:
            for c, place, rendered, start, end in zip(*(batch.column(n).to_pylist() for n in range(5))):
                if state is None or c != conv:
                    if state is not None:
                        out.append(row())
                    state, conv = new(), c
                if place != state[0]:
                    raise ValueError("turns of a conversation are not in order")
                role, text = parse(rendered)
                learned = unescape(rendered[start:end])
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(learned)
                state[3].update(learned.encode())
                state[4] += len(rendered)
            if len(out) >= _ROWS:
                yield batch_of(out)
                out = []
        if state is not None:
            out.append(row())
        if out:
            yield batch_of(out)

    return formatted.select("conv_id", "place", "rendered", "loss_start", "loss_end").mapInArrow(
        run, f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
