"""Secret scans: Aho-Corasick keywords, regular expressions anchored near the hits, checksums.

One pass of an Aho-Corasick automaton over the lowered text finds every place
where a secret can begin; only there an expression is tried.  Base kinds:

assign  keyword, ``:`` or ``=``, and a value of 12 characters or more
access  ``AKIA`` and 18 characters or more in all
hex     16 hexadecimal digits or more (their keywords are the digits, so runs
        are found by an expression over the text)

Matches of a kind do not overlap and are taken from the left; one that is too
short uses up its characters but is dropped.  On top of these come kinds whose
values carry their own checksum, and count only if it holds:

crc     ``ghp_`` and its like, ``npm_``: 30 characters and six of the CRC32 of them in base 62
luhn    payment card numbers of 13 to 19 digits near a card word, Luhn's sum
iban    account numbers near ``iban``, remainder 1 by 97
jwt     three base64url parts whose first is a JSON object with ``alg``

Spans are in code points, end exclusive.  Null and empty texts have none.
Repeated rows each give their result.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_batch

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "crc", "luhn", "iban", "jwt")
_word = lambda w: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
_KEYS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile("(" + "|".join(map(_word, ("password", "passwd", "secret", "token"))) + "|" + _word("api") + "_?" + _word("key") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]{16,}")
#: Prefixes of tokens that end in a CRC32.
CRC_PREFIXES = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")
CRC = re.compile("(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
CARD_WORDS = ("card", "visa", "mastercard", "credit")
CARD = re.compile(r"[^0-9\n]{0,24}?(?<![0-9])([0-9](?:[ -]?[0-9]){12,18})(?![0-9])")
IBAN = re.compile(r"[Ii][Bb][Aa][Nn][^A-Za-z0-9\n]{0,4}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})(?![A-Z0-9])")
JWT = re.compile(r"(eyJ[A-Za-z0-9_-]{5,})\.[A-Za-z0-9_-]{2,}\.[A-Za-z0-9_-]{10,}")
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


@functools.lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    """Lowered keyword -> (kind, length)."""
    found = ahocorasick.Automaton()
    for kind, keys in (("assign", _KEYS), ("access", ("akia",)), ("crc", CRC_PREFIXES), ("luhn", CARD_WORDS), ("iban", ("iban",)), ("jwt", ("eyj",))):
        for k in keys:
            found.add_word(k, (kind, len(k)))
    found.make_automaton()
    return found


_ASCII_LOWER = {i: i + 32 for i in range(65, 91)}


def lowered(text: str) -> str:
    """ASCII letters lowered; every character keeps its place."""
    if text.isascii():
        return text.lower()
    low = text.lower()
    return low if len(low) == len(text) else text.translate(_ASCII_LOWER)


def crc_holds(body: str, check: str) -> bool:
    n, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, d = divmod(n, 62)
        out = _DIGITS[d] + out
    return out == check


def luhn_holds(number: str) -> bool:
    d = [int(c) for c in number if c.isdigit()][::-1]
    return len(set(d)) > 1 and (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def iban_holds(number: str) -> bool:
    s = number.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def jwt_holds(head: str) -> bool:
    try:
        return "alg" in json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4)))
    except ValueError:
        return False


def _try(kind: str, text: str, at: int, end_of_key: int) -> tuple[int, int, int, bool] | None:
    """(start, end, end of what is used up, whether it counts) of a match that begins at a keyword."""
    if kind == "assign":
        m = ASSIGN.match(text, at)
        return m and (m.start(), m.end(), m.end(), len(m[2]) >= 12)
    if kind == "access":
        m = ACCESS.match(text, at)
        return m and (m.start(), m.end(), m.end(), m.end() - m.start() >= 18)
    if kind == "crc":
        m = CRC.match(text, at)
        return m and (m.start(), m.end(), m.end(), crc_holds(m[1], m[2]))
    if kind == "luhn":
        m = CARD.match(text, end_of_key)
        return m and (m.start(1), m.end(1), m.end(1), luhn_holds(m[1]))
    if kind == "iban":
        m = IBAN.match(text, at)
        if not m:
            return None
        # the run may go on into words: the longest part that holds is the number
        stops = [i for i in range(m.end(1), m.start(1) + 14, -1) if text[i - 1] != " " and iban_holds(text[m.start(1) : i])]
        return (m.start(1), stops[0], stops[0], True) if stops else None
    m = JWT.match(text, at)
    return m and (m.start(), m.end(), m.end(), jwt_holds(m[1]))


def spans(text: str | None) -> Iterator[tuple[int, int, int]]:
    """(start, place of the kind in KINDS, end) of every span of a text."""
    if not text:
        return
    used = dict.fromkeys(KINDS, 0)
    for last, (kind, n) in automaton().iter(lowered(text)):
        at = last - n + 1
        if at >= used[kind] and (m := _try(kind, text, at, last + 1)):
            start, end, used[kind], counts = m
            if counts:
                yield start, KINDS.index(kind), end
    for m in HEX.finditer(text):
        yield m.start(), 2, m.end()


def _line(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)


def _batch(b: pa.RecordBatch) -> pa.RecordBatch:
    rows = []
    for text in b.column("text").to_pylist():
        found = sorted(spans(text))
        base = [x for x in found if x[1] < len(BASE)]
        rows.append((*(sum(k == i for _, k, _ in base) for i in range(3)), hashlib.sha256(_line(base).encode()).hexdigest(), _line(found)))
    cols = list(zip(*rows, strict=True)) or [[]] * 5
    kinds = (pa.int64(),) * 3 + (pa.string(),) * 2
    return pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, digest of the base spans, and all spans, of each row."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return per_batch(slim, _batch, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
