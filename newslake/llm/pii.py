"""Format-preserving pseudonyms: personal values are permuted within their format by a keyed Feistel network.

A value is recognised by its form and, where its kind has one, its check (Luhn, remainder 97, ranges, calendar). It is
read as a number below the count of valid values of its format, that number is permuted under the key, and the result
is written in the same format with new check digits. The permutation has no state, so equal values get equal
pseudonyms in all documents and on all machines, and whoever has the key can undo it.

Secrets are what follows a keyword in any case, alone or as part of a longer name set off by ``_`` or ``-``
(``DB_PASSWORD``, ``access_token``), to the end of the token, and what follows ``Bearer`` if it has a digit and 16 characters. Dates are year-month-day, day-month-year and,
where that is no date, month-day-year, with parts of one or two digits, and months by their English names before or
after the day. These forms stay as they are: secrets of fewer than eight characters, without a keyword, after one that
runs into a longer name (``accessToken``), or from the first character on that is not a letter, a digit or one of
``_+/.=-``; dates with years of two digits or outside 1900 to 2099, ordinals (25th), names of months in upper or
lower case or in other languages, dates without a year, and times of day.
"""

import datetime
import hashlib
import re
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from newslake.llm import common  # noqa: F401  ships this package with its tasks

ROUNDS = 10
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_MONTHS = ("January February March April May June July August September October November December").split()
_MONTH_NUMBERS = {m[:3].lower(): k + 1 for k, m in enumerate(_MONTHS)}
_PIECE = 128
_FIRST_DAY, _DAYS = datetime.date(1900, 1, 1).toordinal(), 73_049  # to the end of 2099


class Feistel:
    """A keyed permutation of the numbers below ``size``, for each ``size`` and ``tweak`` another one.

    The number is a pair below ``a`` and ``b`` with ``a * b >= size``; rounds add a keyed hash of one half to the
    other. A result beyond ``size`` is permuted again until it is below.
    """

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _hash(self, tweak, size, k, half, modulus):
        data = f"{tweak}|{size}|{k}|{half}".encode()
        digest = hashlib.blake2b(data, key=self.key, digest_size=max(16, modulus.bit_length() // 8 + 9)).digest() \
            if modulus.bit_length() < 400 else hashlib.shake_256(self.key + data).digest(modulus.bit_length() // 8 + 9)
        return int.from_bytes(digest, "big") % modulus

    def permute(self, number: int, size: int, tweak: str, undo: bool = False) -> int:
        if not 0 <= number < size:
            raise ValueError("number beyond its format")
        a = max(1, isqrt(max(0, size - 1)) + 1)
        b = -(-size // a)
        while True:
            x, y = divmod(number, b)
            for k in reversed(range(ROUNDS)) if undo else range(ROUNDS):
                sign = -1 if undo else 1
                if k % 2:
                    y = (y + sign * self._hash(tweak, size, k, x, b)) % b
                else:
                    x = (x + sign * self._hash(tweak, size, k, y, a)) % a
            number = x * b + y
            if number < size:
                return number

    def characters(self, text: str, tweak: str, undo: bool = False) -> str:
        """Letters and digits permuted among their kind; all else, and upper case, stays where it is."""
        radix = [10 if c.isdigit() else 26 for c in text if c.isascii() and c.isalnum()]
        number, size = 0, 1
        for c in text:
            if c.isascii() and c.isalnum():
                r = 10 if c.isdigit() else 26
                number, size = number * r + (int(c) if r == 10 else _LETTERS.index(c.lower())), size * r
        if size == 1:
            return text
        shape = "".join("d" if r == 10 else "l" for r in radix)
        number, made = self.permute(number, size, f"{tweak}|{shape}", undo), []
        for c in reversed(text):
            if c.isascii() and c.isalnum():
                number, digit = divmod(number, 10 if c.isdigit() else 26)
                c = str(digit) if c.isdigit() else _LETTERS[digit].upper() if c.isupper() else _LETTERS[digit]
            made.append(c)
        return "".join(reversed(made))

    def digits(self, text: str, alphabet: str, tweak: str, undo: bool = False) -> str:
        number = 0
        for c in text:
            number = number * len(alphabet) + alphabet.index(c)
        number, made = self.permute(number, len(alphabet) ** len(text), f"{tweak}|{len(text)}", undo), []
        for _ in text:
            number, digit = divmod(number, len(alphabet))
            made.append(alphabet[digit])
        return "".join(reversed(made))


def _dress(shape: str, plain: str) -> str:
    """``plain`` letters and digits in the places of those of ``shape``."""
    source = iter(plain)
    return "".join(next(source) if c.isalnum() else c for c in shape)


def luhn(digits: str) -> int:
    """The check digit that follows ``digits``."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def _card(f, m, undo):
    digits = re.sub(r"\D", "", m[0])
    if int(digits[-1]) != luhn(digits[:-1]) or len(set(digits)) == 1:
        return None
    body = f.digits(digits[:-1], "0123456789", "card", undo)
    return _dress(m[0], body + str(luhn(body)))


def _remainder(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


def _iban(f, m, undo):
    plain = m[0].replace(" ", "")
    if not 15 <= len(plain) <= 34 or _remainder(plain[4:] + plain[:4]) != 1:
        return None
    body = f.characters(plain[4:], "iban" + plain[:2], undo)
    return _dress(m[0], f"{plain[:2]}{98 - _remainder(body + plain[:2] + '00'):02d}{body}")


def _social(f, m, undo):
    area, group, serial = (int(x) for x in (m[0][:3], m[0][4:6], m[0][7:]))
    if area in (0, 666) or area > 899 or not group or not serial:
        return None
    area -= 1 + (area > 666)
    number = f.permute((area * 99 + group - 1) * 9999 + serial - 1, 898 * 99 * 9999, "social", undo)
    number, serial = divmod(number, 9999)
    area, group = divmod(number, 99)
    area += 1 + (area >= 665)
    return f"{area:03d}{m[0][3]}{group + 1:02d}{m[0][6]}{serial + 1:04d}"


def _phone(f, m, undo):
    digits = re.sub(r"\D", "", m[0])
    prefix = digits[:-10]
    if prefix in ("", "1") and len(digits) >= 10:
        own = digits[-10:]
        if own[0] in "01" or own[3] in "01":
            return None
        number = (int(own[:3]) - 200) * 800 + int(own[3:6]) - 200
        number = f.permute(number * 10_000 + int(own[6:]), 800 * 800 * 10_000, "phone", undo)
        number, line = divmod(number, 10_000)
        area, exchange = divmod(number, 800)
        return _dress(m[0], f"{prefix}{area + 200}{exchange + 200}{line:04d}")
    if not m[0].startswith("+") or not 8 <= len(digits) <= 15:
        return None
    # Abroad the first group, or two digits, is the country and stays.
    country = re.match(r"\+(\d{1,3})(?=\D)|\+(\d\d)", m[0])
    keep = (country[1] or country[2]) if country else ""
    return _dress(m[0], keep + f.digits(digits[len(keep):], "0123456789", "phone" + keep, undo))


def _address(f, m, undo):
    parts = [int(x) for x in m[0].split(".")]
    if max(parts) > 255:
        return None
    number = f.permute(int.from_bytes(bytes(parts), "big"), 1 << 32, "address", undo)
    return ".".join(map(str, number.to_bytes(4, "big")))


def _mail(f, m, undo):
    local, _, domain = m[0].rpartition("@")
    host, dot, top = domain.rpartition(".")
    return f.characters(f"{local}@{host}".lower(), "mail", undo) + dot + top


def _date(f, m, undo):
    part = m.groupdict()
    form = next(k for k in "1234" if part[f"y{k}"])
    year, month, day = (part[c + form] for c in "ymd")
    month_first = False
    try:
        if form in "34":
            when = datetime.date(int(year), _MONTH_NUMBERS[month[:3].lower()], int(day))
        else:
            if form == "2" and int(month) > 12:
                month_first, month, day = True, day, month
            when = datetime.date(int(year), int(month), int(day))
    except ValueError:
        return None
    number = when.toordinal() - _FIRST_DAY
    if not 0 <= number < _DAYS:
        return None

    def fits(new):
        """The date can be written in this form, and is read in the same way again."""
        if form == "3":
            return True
        if len(day) == 1 and new.day > 9 or month_first and new.day < 13:
            return False
        return (len(month) == 3 or new.month != 5) if form == "4" else len(month) == 2 or new.month < 10
    # Permuted until it fits, which permutes the dates that do.
    while True:
        number = f.permute(number, _DAYS, "date", undo)
        new = datetime.date.fromordinal(number + _FIRST_DAY)
        if fits(new):
            break
    name = _MONTHS[new.month - 1]
    if form == "3":
        name = name if len(month) > 3 and month.lower() != "may" else name[:3]
        return f"{name} {new.day}, {new.year}"
    new_day, new_month = f"{new.day:0{len(day)}d}", f"{new.month:0{len(month)}d}"
    if form == "4":
        return f"{new_day} {name if len(month) > 3 else name[:3]}{part['g4']}{new.year}"
    if form == "1":
        return f"{new.year}{part['s1']}{new_month}{part['s1']}{new_day}"
    return f"{part['s2']}".join((new_month, new_day) if month_first else (new_day, new_month)) + f"{part['s2']}{new.year}"


def _secret(f, m, undo):
    head, value = m["head"], m["value"]
    if not any(map(str.isalnum, value)):
        return None
    # Long values in even pieces, as the cost of a number grows with the square of its length.
    n, made = -(-len(value) // _PIECE), []
    plain_hex = re.fullmatch(r"[0-9a-f]+", value)
    for k in range(n):
        piece, tweak = value[len(value) * k // n:len(value) * (k + 1) // n], f"secret{k}" if k else "secret"
        made.append(f.digits(piece, "0123456789abcdef", tweak, undo) if plain_hex else f.characters(piece, tweak, undo))
    return head + "".join(made)


def _access_key(f, m, undo):
    return m[0][:4] + f.digits(m[0][4:], "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ", "access key", undo)


_KINDS = {
    "email": (r"(?<![\w.+-])[A-Za-z0-9][\w.+-]{0,63}@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,24}(?![\w-])", _mail),
    "access_key": (r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])", _access_key),
    "secret": (r"(?P<head>(?<![\w-])(?:[\w-]{0,40}[_-])?(?i:token|password|passwd|secret|api_?key)(?:[_-][\w-]{0,40})?[\"']?\s{0,3}[=:]\s{0,3}[\"']?)"
               r"(?P<value>[A-Za-z0-9_+/.=-]{8,})", _secret),
    "bearer": (r"(?P<head>\b[Bb]earer\s{1,3})(?P<value>(?=\S{0,200}?\d)[A-Za-z0-9_+/.=~-]{16,})", _secret),
    "iban": (r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?![A-Za-z0-9])", _iban),
    "card": (r"(?<![\d.-])(?:\d{4}(?P<sep>[ -])\d{4}(?P=sep)\d{4}(?P=sep)\d{1,7}|\d{4}(?P<sep2>[ -])\d{6}(?P=sep2)\d{5}|\d{13,19})(?!\d)", _card),
    "phone": (r"(?<![\w+])(?:\+?1[ .-]?)?(?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\d)", _phone),
    "social": (r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])", _social),
    "address": (r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)", _address),
    "date": (r"(?<![\d/.-])(?P<y1>(?:19|20)\d\d)(?P<s1>[-/.])(?P<m1>\d{1,2})(?P=s1)(?P<d1>\d{1,2})(?![\d/-])"
             r"|(?<![\d/.-])(?P<d2>\d{1,2})(?P<s2>[-/.])(?P<m2>\d{1,2})(?P=s2)(?P<y2>(?:19|20)\d\d)(?![\d/-])"
             r"|\b(?P<m3>(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]{0,6})\.? (?P<d3>\d{1,2}), (?P<y3>(?:19|20)\d\d)\b"
             rf"|(?<![\d/.-])(?P<d4>\d{{1,2}}) (?P<m4>{'|'.join(_MONTHS)}|{'|'.join(m[:3] for m in _MONTHS)})(?P<g4>\.?,? )(?P<y4>(?:19|20)\d\d)\b", _date),
}
_PATTERNS = [(kind, re.compile(pattern), change) for kind, (pattern, change) in _KINDS.items()]
_ANY = re.compile(r"[0-9@=:]")


def pseudonymise(text: str, feistel: Feistel, undo: bool = False):
    """The text with pseudonyms, and the kinds found, one for each value.

    Kinds are looked for in a fixed order; what one has taken is no longer open to the next.
    """
    if not _ANY.search(text):
        return text, []
    parts, found = [(text, False)], []
    for kind, pattern, change in _PATTERNS:
        after = []
        for part, done in parts:
            if done:
                after.append((part, done))
                continue
            at = 0
            for m in pattern.finditer(part):
                new = change(feistel, m, undo)
                if new is not None:
                    after += [(part[at:m.start()], False), (new, True)]
                    at = m.end()
                    found.append(kind)
            after.append((part[at:], False))
        parts = after
    return "".join(p for p, _ in parts), found


def pseudonymise_documents(docs: DataFrame, key: bytes, text_col: str = "text", length_col: str | None = None,
                           with_kinds: str | None = None) -> DataFrame:
    """``docs`` with pseudonyms in its texts; all other columns stay, rows neither move nor vanish.

    ``length_col`` names a column that holds the text's length in characters and is set anew where it is not null;
    ``with_kinds`` names a new column for the array of kinds found, one entry for each value. A null text stays null
    with no kinds, an empty one empty. Repeated rows are repeated, an empty table gives an empty table. Values are
    looked for in the whole text, however long. Nothing is shuffled.
    """
    names = docs.columns
    at, length_at = names.index(text_col), names.index(length_col) if length_col else None
    extra = [T.StructField(with_kinds, T.ArrayType(T.StringType()))] if with_kinds else []
    schema = T.StructType([*docs.schema.fields, *extra])

    def run(batches):
        feistel = Feistel(key)
        for batch in batches:
            texts, kinds, lengths = [], [], []
            for text in batch.column(at).to_pylist():
                new, found = pseudonymise(text, feistel) if text is not None else (None, [])
                texts.append(new)
                kinds.append(found)
                lengths.append(None if new is None else len(new))
            columns = list(batch.columns)
            columns[at] = pa.array(texts, columns[at].type)
            if length_at is not None:
                old = columns[length_at]
                columns[length_at] = pa.array([o if n is None or o is None else n for o, n in zip(old.to_pylist(), lengths)], old.type)
            if with_kinds:
                columns.append(pa.array(kinds, pa.list_(pa.string())))
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, *([with_kinds] if with_kinds else [])])

    return docs.mapInArrow(run, schema)
