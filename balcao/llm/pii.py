"""Format-preserving pseudonyms for personal data by keyed Feistel permutations.

Every finding is validated (check digits, calendar, ranges), numbered within the
finite set of values of its own format, moved by a keyed permutation of that
set, and written back in the same format. Equal values get equal pseudonyms in
all documents, different ones different pseudonyms, and the result passes the
same validation. Separators and the order of a date make no difference; letters
count as they are written. Candidates that fail validation stay as they are.

Null texts stay null and empty ones empty; long ones are read whole. Rows do not
depend on each other, so repeated rows, ties and missing ids need no rule, and an
empty table gives an empty one. Other columns are kept, whatever their names.
"""

from __future__ import annotations

import re
import secrets
from collections.abc import Callable
from datetime import date, timedelta
from functools import lru_cache
from hashlib import blake2b
from math import isqrt, prod

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The session setting that holds the secret key.
KEY_SETTING = "spark.balcao.pii.key"
ROUNDS = 8
#: Longer texts are not hashed anew for each part of them, nor are their pseudonyms cached.
LONG = 512
LOWER, UPPER, DIGITS, HEX = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "0123456789abcdef"
KINDS = ["email", "secret", "iban", "ip", "phone", "national_id", "date", "card"]

_FIND = re.compile(
    r"""
    (?P<email>(?<![A-Za-z0-9_%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9-]))
  | (?P<secret>(?<=["'])[A-Za-z0-9+/_=.-]{16,}+(?=["']))
  | (?P<iban>(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))
  | (?P<ip>(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9]))
  | (?P<phone>\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])
      |(?<![0-9])\([0-9]{3}\)[ ]?[0-9]{3}-[0-9]{4}(?![0-9])
      |(?<![0-9-])[0-9]{3}-[0-9]{3}-[0-9]{4}(?![0-9-]))
  | (?P<national_id>(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-]))
  | (?P<date>(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[/.][0-9]{2}[/.][0-9]{4})(?![0-9]|[./-][0-9]))
  | (?P<card>(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9]))
    """,
    re.VERBOSE,
)
#: What stands before a quoted secret.
_SECRET_NAME = re.compile(r"(?i)(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)\w{0,20}[ \t]{0,8}[=:][ \t]{0,8}[\"']$")
#: Country codes of one and two digits; all others have three.
_COUNTRY_CODE = re.compile("[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3}")
#: A text without any of these has no finding.
_MAY_HAVE = re.compile(r"[0-9@\"']")


class Feistel:
    """Keyed permutations of 0 .. size - 1, one for each tweak and size.

    The number is split into two digits of nearly equal bases, which are added
    up with keyed hashes of one another in turn; numbers beyond ``size`` are
    permuted again until they fall inside.
    """

    def __init__(self, key: bytes):
        self.key = key

    def _hash(self, tweak: str, step: int, size: int, value: int) -> int:
        said = f"{tweak}\x00{step}\x00{size}\x00{value}".encode()
        return int.from_bytes(blake2b(said, key=self.key, digest_size=max(16, (size.bit_length() + 7) // 16 + 8)).digest())

    def permute(self, value: int, size: int, tweak: str, back: bool = False) -> int:
        if size < 2:
            return value
        a = isqrt(size - 1) + 1
        b = -(-size // a)
        while True:
            left, right = value // b, value % b
            for step in reversed(range(ROUNDS)) if back else range(ROUNDS):
                sign = -1 if back else 1
                if step % 2:
                    right = (right + sign * self._hash(tweak, step, size, left)) % b
                else:
                    left = (left + sign * self._hash(tweak, step, size, right)) % a
            value = left * b + right
            if value < size:
                return value


def _spelled(text: str, alphabet_of: Callable[[str], str | None], f: Feistel, tweak: str, back: bool) -> str:
    """Each character moves within its own alphabet; others stay and, as part of the format, choose the permutation."""
    sets = [alphabet_of(c) for c in text]
    shape = "".join("?" if s else c for c, s in zip(text, sets)) + "|" + "".join(s[0] + str(len(s)) for s in sets if s)
    sizes = [len(s) for s in sets if s]
    value = 0
    for c, s in zip(text, sets):
        if s:
            value = value * len(s) + s.index(c)
    # 64 bytes of digest bound the sizes a permutation mixes well; longer ones move in parts.
    value = f.permute(value, prod(sizes), f"{tweak}:{shape}", back)
    digits = []
    for s in reversed([s for s in sets if s]):
        value, d = divmod(value, len(s))
        digits.append(s[d])
    return "".join(digits.pop() if s else c for c, s in zip(text, sets))


def _in_parts(text: str, alphabet_of: Callable[[str], str | None], f: Feistel, tweak: str, back: bool, part: int = 40) -> str:
    """Long texts in parts, each keyed by the text before it, or by its running digest beyond LONG characters."""
    out, plain, digest = [], "", blake2b(digest_size=32)
    for at in range(0, len(text), part):
        piece = text[at : at + part]
        before = plain if at <= LONG else f"\x00{digest.hexdigest()}"
        moved = _spelled(piece, alphabet_of, f, f"{tweak}:{before}" if before else tweak, back)
        out.append(moved)
        known = moved if back else piece
        digest.update(known.encode())
        if at < LONG:
            plain += known
    return "".join(out)


def _alnum(c: str) -> str | None:
    return LOWER if c in LOWER else UPPER if c in UPPER else DIGITS if c in DIGITS else None


def _digit(c: str) -> str | None:
    return DIGITS if c in DIGITS else None


def _hex(c: str) -> str | None:
    return HEX if c in HEX else None


def _email(text: str, f: Feistel, back: bool) -> str:
    local, _, domain = text.rpartition("@")
    name, _, top = domain.rpartition(".")
    return f"{_in_parts(local, _alnum, f, 'local', back)}@{_in_parts(name, _alnum, f, 'domain', back)}.{top}"


def _secret(text: str, f: Feistel, back: bool) -> str | None:
    if not re.search("[0-9]", text):
        return None
    alike = all(c in HEX for c in text)
    return _in_parts(text, _hex if alike else _alnum, f, "hex" if alike else "secret", back)


def luhn_digit(payload: str) -> str:
    total = sum(d if i % 2 else (2 * d - 9 * (d > 4)) for i, d in enumerate(map(int, reversed(payload))))
    return str(-total % 10)


def _card(text: str, f: Feistel, back: bool) -> str | None:
    digits = re.sub("[ -]", "", text)
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1] or not digits.strip("0"):
        return None
    size = 10 ** (len(digits) - 1) - 1  # the number of all zeros is none
    moved = f"{f.permute(int(digits[:-1]) - 1, size, 'card', back) + 1:0{len(digits) - 1}d}"
    rest = iter(moved + luhn_digit(moved))
    return "".join(next(rest) if c in DIGITS else c for c in text)


def iban_check(country: str, account: str) -> str:
    return f"{98 - int(''.join(str(int(c, 36)) for c in account + country + '00')) % 97:02d}"


def _iban(text: str, f: Feistel, back: bool) -> str | None:
    plain = text.replace(" ", "")
    country, check, account = plain[:2], plain[2:4], plain[4:]
    if not 15 <= len(plain) <= 34 or iban_check(country, account) != check:
        return None
    moved = _spelled(account, _alnum, f, f"iban:{country}", back)
    rest = iter(country + iban_check(country, moved) + moved)
    return "".join(c if c == " " else next(rest) for c in text)


def _ip(text: str, f: Feistel, back: bool) -> str | None:
    parts = text.split(".")
    if any(int(p) > 255 or p != str(int(p)) for p in parts):
        return None
    value = int.from_bytes(bytes(map(int, parts)))
    return ".".join(map(str, f.permute(value, 1 << 32, "ip", back).to_bytes(4)))


def _phone(text: str, f: Feistel, back: bool) -> str | None:
    """Country code and separators stay; 7 to 15 digits in all.

    The digits alone choose the pseudonym. Numbers without a plus are spelled as
    North American ones only and count as those of country code 1.
    """
    digits = re.sub("[^0-9]", "", text)
    if not 7 <= len(digits) <= 15:
        return None
    code = _COUNTRY_CODE.match(digits)[0] if text[0] == "+" else ""
    rest = digits[len(code) :]
    moved = iter(f"{code}{f.permute(int(rest), 10 ** len(rest), f'phone:{code or 1}', back):0{len(rest)}d}")
    return "".join(next(moved) if c in DIGITS else c for c in text)


def _national_id(text: str, f: Feistel, back: bool) -> str | None:
    """Areas 001 to 899 but 666, groups 01 to 99, serials 0001 to 9999."""
    area, group, serial = map(int, text.split("-"))
    if area in (0, 666) or area > 899 or not group or not serial:
        return None
    value = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    value, serial = divmod(f.permute(value, 898 * 99 * 9999, "national_id", back), 9999)
    area, group = divmod(value, 99)
    return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"


def _date(text: str, f: Feistel, back: bool) -> str | None:
    """Valid days move within 1900 to 2099, others within their century.

    The day alone chooses the pseudonym, however it is written. Texts that are a
    day only with the month first stay so, as days beyond the 12th stay beyond it.
    """
    if "-" in text:
        order, numbers = "iso", list(map(int, text.split("-")))
    else:
        d, m, y = map(int, re.split("[/.]", text))
        order, numbers = ("day first", [y, m, d]) if m <= 12 else ("month first", [y, d, m])
    try:
        day = date(*numbers)
    except ValueError:
        return None
    first, last = (1900, 2099) if 1900 <= day.year <= 2099 else (max(1, day.year // 100 * 100), day.year // 100 * 100 + 99)
    start = date(first, 1, 1)
    size = (date(last, 12, 31) - start).days + 1
    late = day.day > 12
    while True:
        day = start + timedelta(f.permute((day - start).days, size, f"date:{first}", back))
        if (day.day > 12) == late:
            break
    if order == "iso":
        return f"{day.year:04d}-{day.month:02d}-{day.day:02d}"
    one, two = (day.day, day.month) if order == "day first" else (day.month, day.day)
    return f"{one:02d}{text[2]}{two:02d}{text[5]}{day.year:04d}"


_MOVES = {
    "email": _email, "secret": _secret, "iban": _iban, "ip": _ip, "phone": _phone,
    "national_id": _national_id, "date": _date, "card": _card,
}


class Pseudonyms:
    """Texts with their findings replaced under one key."""

    def __init__(self, key: str):
        self.feistel = Feistel(blake2b(key.encode(), digest_size=32).digest())
        self.moved = lru_cache(maxsize=50_000)(self._moved)

    def _moved(self, kind: str, value: str) -> str | None:
        return _MOVES[kind](value, self.feistel, False)

    def restore(self, kind: str, value: str) -> str | None:
        """The value a pseudonym stands for."""
        return _MOVES[kind](value, self.feistel, True)

    def replace(self, text: str | None) -> tuple[str | None, list[tuple[str, int, int]]]:
        """The new text, and kind, start and end of each finding in the old one."""
        if not text or not _MAY_HAVE.search(text):
            return text, []
        out, found, done, at = [], [], 0, 0
        while match := _FIND.search(text, at):
            kind, (start, end) = match.lastgroup, match.span()
            named = kind != "secret" or _SECRET_NAME.search(text, max(0, start - 64), start)
            moved = (self.moved if end - start <= LONG else self._moved)(kind, match[0]) if named else None
            while moved is None and kind == "card" and (cut := max(map(text[start:end].rfind, " -"))) > 0:
                end = start + cut  # the groups behind may belong to something else
                moved = self.moved(kind, text[start:end])
            if moved is None:
                at = self._next_place(text, start)
                continue
            out += [text[done:start], moved]
            found.append((kind, start, end))
            done = at = end
        return "".join([*out, text[done:]]), found

    @staticmethod
    def _next_place(text: str, start: int) -> int:
        """Where to look on after a candidate that is none: a part of it may be another kind's."""
        return start + len(re.match("[0-9]+|.", text[start:start + 64], re.DOTALL)[0])


_FRESH: dict[str, str] = {}


def key_of(spark: SparkSession) -> str:
    """The secret key, from the setting KEY_SETTING.

    Without it a random one is made for the application: pseudonyms are then
    linked within its run only, and nobody can undo them.
    """
    own = spark.conf.get(KEY_SETTING, None)
    return own or _FRESH.setdefault(spark.sparkContext.applicationId, secrets.token_hex(32))


@lru_cache(maxsize=4)
def pseudonyms(key: str) -> Pseudonyms:
    return Pseudonyms(key)


def replaced(text: Column, key: str) -> Column:
    """Struct of the new ``text``, ``n_pii``, and ``spans``: kind, start and end in code points of the old text."""

    @F.arrow_udf("text string, n_pii long, spans array<struct<kind:string,start:long,end:long>>")
    def moved(texts: pa.Array) -> pa.Array:
        done = [pseudonyms(key).replace(t.as_py()) for t in texts]
        span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        return pa.StructArray.from_arrays(
            [
                pa.array([d[0] for d in done], pa.string()),
                pa.array([len(d[1]) for d in done], pa.int64()),
                pa.array([[dict(zip(("kind", "start", "end"), s)) for s in d[1]] for d in done], pa.list_(span)),
            ],
            ["text", "n_pii", "spans"],
        )

    return moved(text)


def pseudonymize(docs: DataFrame, key: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, the new text, ``n_pii`` and one count per kind. Null texts stay null."""
    kinds = F.col("_done.spans.kind")
    counts = [F.size(F.array_remove(kinds, k)).cast("long") for k in KINDS]
    counts = [(F.col("_done.n_pii") - left).alias(f"n_{k}") for k, left in zip(KINDS, counts)]
    return docs.select(F.col(id_col).alias("doc_id"), replaced(F.col(text), key).alias("_done")).select(
        "doc_id", "_done.text", "_done.n_pii", *counts
    )


def pseudonymize_rows(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """All columns of ``docs``, with findings in ``text`` replaced."""
    rows = docs.select(F.struct("*").alias("row"))
    done = rows.select("row", replaced(F.col("row")[text], key).alias("done"))
    return done.select(*[(F.col("done.text") if c == text else F.col("row")[c]).alias(c) for c in docs.columns])
