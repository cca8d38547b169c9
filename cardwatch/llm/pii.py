"""Personal data by anchor expansion.

One Aho-Corasick automaton walks each whole text and reports anchors: at-signs,
schemes, plus-digit, digit pairs (adjacent, or across a space, hyphen or dot)
and identifier cues.  A small deterministic parser per kind grows the anchor
to its boundaries and validates what it finds:

* ``email``: local part leftwards, dotted labels rightwards from an at-sign;
* ``ip``: four dotted numbers, none above 255;
* ``card``: 14 to 19 digits with single spaces or hyphens, Luhn-checked;
* ``phone``: plus sign, 10 to 15 digits;
* ``login``: a URL with user and password before its host;
* ``iban``: country, check digits and account, by the mod-97 rule;
* ``account``: 6 to 17 digits directly after a cue word such as "account no.".

The first four are the base kinds; each equals a leftmost, non-overlapping
pattern scan whose failing matches are dropped without a retry.

Defined cases: NULL text is empty; long texts are scanned whole; spans of
different kinds may overlap, and equal starts keep the order of the kinds; offsets are code points, ends exclusive; an
empty table gives an empty result; repeated rows give repeated results; further
columns are kept, except those named like an output, which are replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.common import all_but, fresh, python_workers

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "login", "iban", "account")
CUES = ("account", "acct", "konto", "compte", "cuenta")
SCHEMES = ("http://", "https://", "ftp://", "ssh://", "postgres://", "mysql://")

_DIGITS = "0123456789"
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBER = re.compile(r"[0-9]+")
_CARD_REST = re.compile(r"(?:[\x20-]?[0-9])+")
_PHONE_REST = re.compile(r"[\x20().0-9-]+")
_LOGIN = re.compile(r"[A-Za-z0-9._%+-]+:[^\s/@]+@[A-Za-z0-9.-]+")
_ACCOUNT = re.compile(r"(?:\s+(?:no\.?|number|nr\.?|n°))?\s*[:#]?\s*([0-9]{6,17})(?![0-9A-Za-z])", re.I)
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{1,4}){3,8}")
_IBAN_CUE = re.compile("IBAN|iban|Iban")


@lru_cache(maxsize=1)
def _automaton():
    a = ahocorasick.Automaton()
    a.add_word("@", ("email", 1))
    for x in _DIGITS:
        a.add_word("+" + x, ("phone", 2))
        for y in _DIGITS:
            a.add_word(f"{x}.{y}", ("ip", 3))
            for sep in ("", " ", "-"):
                a.add_word(x + sep + y, ("card", 2 + len(sep)))
    for scheme in SCHEMES:
        a.add_word(scheme, ("login", len(scheme)))
    for cue in CUES:
        for form in {cue, cue.capitalize(), cue.upper()}:
            a.add_word(form, ("account", len(form)))
    for form in ("IBAN", "iban", "Iban"):
        a.add_word(form, ("iban", 4))
    a.make_automaton()
    return a


def _email(text: str, at: int, floor: int):
    start = at
    while start > floor and text[start - 1] in _LOCAL:
        start -= 1
    m = _DOMAIN.match(text, at + 1) if start < at else None
    return (start, m.end(), True) if m else None


def _digit_run_start(text: str, at: int, floor: int) -> int:
    while at > floor and text[at - 1] in _DIGITS:
        at -= 1
    return at


def _ip(text: str, at: int, floor: int):
    start = end = _digit_run_start(text, at, floor)
    valid = True
    for part in range(4):
        m = _NUMBER.match(text, end + (part > 0))
        if not m or part and text[end] != ".":
            return None
        valid &= len(m[0].lstrip("0")) <= 3 and int(m[0].lstrip("0") or "0") <= 255
        end = m.end()
        if part < 3 and end >= len(text):
            return None
    return start, end, valid


def _luhn(digits: str) -> bool:
    twice = [int(d) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(2 * d - 9 * (d > 4) for d in twice)) % 10 == 0


def _card(text: str, at: int, floor: int):
    m = _CARD_REST.match(text, at + 1)
    digits = re.sub("[^0-9]", "", text[at:m.end()])
    return at, m.end(), 14 <= len(digits) <= 19 and _luhn(digits)


def _phone(text: str, at: int, floor: int):
    m = _PHONE_REST.match(text, at + 2)
    end = m.end() if m else at
    while end > at + 3 and text[end - 1] not in _DIGITS:
        end -= 1
    if end < at + 4:
        return None
    return at, end, 10 <= sum(c in _DIGITS for c in text[at:end]) <= 15


def _login(text: str, at: int, floor: int):
    m = _LOGIN.match(text, text.index("://", at) + 3)
    return (at, m.end(), True) if m else None


def _account(text: str, at: int, floor: int):
    if at and text[at - 1].isalnum():
        return None
    m = _ACCOUNT.match(text, at + next(len(c) for c in CUES if text[at:at + len(c)].lower() == c))
    return (m.start(1), m.end(1), True) if m else None


def _iban(text: str, at: int, floor: int):
    """The first account after the cue, before the next one: of what starts
    like one, the longest stretch that ends at a word's end and passes mod 97."""
    following = _IBAN_CUE.search(text, at + 4)
    stop, start = following.start() if following else len(text), at + 4
    while m := _IBAN.search(text, start, stop):
        for end in range(m.end(), m.start() + 14, -1):
            if text[end - 1] == " " or text[end:end + 1].isalnum():
                continue
            code = text[m.start():end].replace(" ", "")
            if 15 <= len(code) <= 34 and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1:
                return m.start(), end, True
        start = m.start() + 2
    return None


_PARSERS = {"email": _email, "ip": _ip, "card": _card, "phone": _phone, "login": _login, "iban": _iban,
            "account": _account}


def find_spans(text: str) -> list[tuple[int, int, str]]:
    """Validated ``(start, end, kind)`` spans by start, then kind as listed."""
    done = dict.fromkeys(KINDS, 0)
    spans = []
    for last, (kind, length) in _automaton().iter(text):
        at = last - length + 1
        if at < done[kind]:
            continue
        found = _PARSERS[kind](text, at, done[kind])
        if found:
            start, end, valid = found
            done[kind] = end
            if valid:
                spans.append((start, end, kind))
    spans.sort(key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
    return spans


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


FOUND = ("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def _scan(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    names = [f"n_{k}" for k in BASE] + ["base_sha256", "spans"]
    for batch in texts:
        rows = []
        for text in batch:
            spans = find_spans(text or "")
            base = [s for s in spans if s[2] in BASE]
            rows.append((*[sum(s[2] == k for s in base) for k in BASE],
                         hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
        yield pd.DataFrame(rows, columns=names)


def find_personal_data(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_email``, ``n_ip``, ``n_card``, ``n_phone``,
    ``base_sha256`` and ``spans``.  One narrow pass; nothing is shuffled."""
    python_workers(docs.sparkSession)
    scan = F.pandas_udf(_scan, FOUND)
    outputs = [f.split()[0] for f in FOUND.split(", ")]
    kept, found = all_but(docs, *outputs), fresh(docs, "_pii_found")
    marked = docs.select(*kept, scan(F.col(text_col)).alias(found))
    return marked.select(*kept, *[F.col(f"{found}.{o}").alias(o) for o in outputs])


def mask_personal_data(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every found span of the text replaced by ``[kind]``
    (overlapping spans merge under the first one's kind)."""
    python_workers(docs.sparkSession)

    @F.pandas_udf("string")
    def masked(texts: pd.Series) -> pd.Series:
        def one(text):
            if not text:
                return text
            out, at = [], 0
            for start, end, kind in find_spans(text):
                if start >= at:
                    out += [text[at:start], f"[{kind}]"]
                at = max(at, end)
            return "".join(out) + text[at:]
        return texts.map(one, na_action="ignore")

    return docs.withColumn(text_col, masked(F.col(text_col)))


def op5_pii(docs: DataFrame) -> DataFrame:
    """The digest columns of the registered query."""
    return find_personal_data(docs.select("doc_id", "text")).drop("text")
