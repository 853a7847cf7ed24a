"""What a text of JSON holds: one list, or objects one after the other. A small helper for whole files and for streams."""

import json

_BLANK = " \t\r\n"


def values(text: str):
    """``(kind, array, problem)``: the articles of a file as the text of one array.

    ``kind`` is ``"list"`` for one list of objects, ``"objects"`` for one or more objects, as a lone object or as JSON
    lines are. Anything else, such as text after a list, is a problem and gives no array; nothing is read in part.
    """
    decoder = json.JSONDecoder()
    at, found = 1 if text.startswith("\ufeff") else 0, []
    try:
        while True:
            while at < len(text) and text[at] in _BLANK:
                at += 1
            if at == len(text):
                break
            value, end = decoder.raw_decode(text, at)
            found.append((value, text[at:end]))
            at = end
    except (ValueError, RecursionError):
        return None, None, "broken JSON"
    if not found:
        return None, None, "empty"
    if len(found) == 1 and isinstance(found[0][0], list):
        if all(isinstance(v, dict) for v in found[0][0]):
            return "list", found[0][1], None
        return None, None, "a list of other things than objects"
    if all(isinstance(v, dict) for v, _ in found):
        return "objects", f"[{','.join(t for _, t in found)}]", None
    return None, None, "text after the list" if isinstance(found[0][0], list) else "neither list nor objects"


def objects(chunks):
    """The objects of a text that comes in chunks, as texts one after the other; returns ``(kind, problem)`` as ``values`` does.

    Holds a chunk and what an object needs, however long the text is. Objects before a problem are given out, so who
    wants none of them reads twice.
    """
    decoder, chunks, held, at, more = json.JSONDecoder(), iter(chunks), "", 0, True

    def fill(size):
        nonlocal held, at, more
        parts = [held[at:]]
        size -= len(parts[0])
        while more and size > 0:
            chunk = next(chunks, None)
            more = chunk is not None
            parts.append(chunk or "")
            size -= len(parts[-1])
        held, at = "".join(parts), 0

    def ahead():
        """The next character that is not blank."""
        nonlocal at
        while True:
            while at < len(held) and held[at] in _BLANK:
                at += 1
            if at < len(held) or not more:
                return held[at:at + 1]
            fill(1)

    def value():
        nonlocal at
        while True:
            try:
                found, end = decoder.raw_decode(held, at)
                # A number at the end of a chunk may go on in the next.
                if end < len(held) or not more or isinstance(found, (dict, list, str)):
                    text, at = held[at:end], end
                    return found, text
            except json.JSONDecodeError as error:
                # What is cut off fails at its end, or at the start of a string.
                cut = error.pos >= len(held) - 32 or error.msg.startswith("Unterminated string")
                if not more or not cut:
                    raise
            fill(2 * (len(held) - at) + 1)

    tops, begins_with_list, lists, good = 0, False, 0, True
    try:
        fill(1)
        at = 1 if held.startswith("\ufeff") else 0
        while ahead():
            tops += 1
            if held[at] != "[":
                found, text = value()
                good &= isinstance(found, dict)
                if good and not lists:
                    yield text
                continue
            lists, begins_with_list, at = lists + 1, begins_with_list or tops == 1, at + 1
            mark = "]" if ahead() == "]" else ","
            at += mark == "]"
            while mark != "]":
                ahead()
                found, text = value()
                good &= isinstance(found, dict)
                if good and tops == 1:
                    yield text
                mark = ahead()
                at += 1
                if mark not in (",", "]") or not mark:
                    return None, "broken JSON"
    except (ValueError, RecursionError):
        return None, "broken JSON"
    if not tops:
        return None, "empty"
    if begins_with_list:
        return ("list", None) if tops == 1 and good else (None, "text after the list" if tops > 1 else "a list of other things than objects")
    return ("objects", None) if good and not lists else (None, "neither list nor objects")
