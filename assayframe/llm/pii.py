"""PII: an Aho-Corasick automaton finds anchors, local parsers expand them to spans and validate.

Anchors are at-signs, schemes (``://``), plus signs, digits and identifier
cues.  From each anchor a parser looks only at the characters next to it:

- email: left over the local part, right over the domain;
- ip, card: from the first digit of a run on; phone: from the plus sign on;
- url: from the scheme's letters left of ``://`` to the end of host and path,
  if the host has a valid name or address;
- account: the identifier after a cue such as "iban" or "passport": a run of
  letters and digits and further ones that begin with a digit, each after one
  space or hyphen; 6 characters or more with 4 digits or more.

No parser has a longest span, and each character is looked at by few of them,
so a text takes time in proportion to its length.

email, ip, card and phone are the base kinds: exactly the leftmost
non-overlapping matches of their patterns, failing matches dropped.  url and
account spans are the method's additions.

Defined cases: null text is empty and has no spans; texts are scanned whole;
repeated rows give repeated results; positions are code points, end
exclusive; other columns are dropped by ``digest`` and passed through by
``find_spans``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import map_batches

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account")
CUES = ("iban", "passport", "account", "acct", "ssn", "kontonummer", "cuenta", "compte")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = frozenset("0123456789")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_AUTHORITY = re.compile(r"(?:[A-Za-z0-9._~%!$&'()*+,;=:-]+@)?[A-Za-z0-9](?:[A-Za-z0-9-]*\.)+[A-Za-z0-9-]*[A-Za-z0-9](?::[0-9]+)?(?:[/?#][^\s\"'<>]*)?")
_ACCOUNT = re.compile(r"(?:\s{0,3}(?:no\.?|number|nr\.?|id))?\s{0,3}[:=#]?\s{0,3}([A-Za-z0-9]+(?:[ -][0-9][A-Za-z0-9]*)*)")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for word in ("@", "+", "://", *"0123456789"):
        found.add_word(word, word)
    for cue in CUES:
        for form in {cue, cue.upper(), cue.capitalize()}:
            found.add_word(form, "cue")
    found.make_automaton()
    return found


def spans(text: str, anchors) -> list[tuple[str, int, int]]:
    """All (kind, start, end) of one text, by kind as listed and then start."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    free = dict.fromkeys(KINDS, 0)  # where the kind's next span may start

    def email(at: int) -> None:
        start = at
        while start > free["email"] and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            found["email"].append((start, m.end()))
            free["email"] = m.end()

    def digit(at: int) -> None:
        if at >= free["ip"] and (at == 0 or text[at - 1] not in _DIGITS) and (m := _IP.match(text, at)):
            free["ip"] = m.end()
            if all(len(x) <= 3 and int(x or "0") <= 255 for x in (y.lstrip("0") for y in m.groups())):
                found["ip"].append(m.span())
        if at >= free["card"] and (m := _CARD.match(text, at)):
            free["card"] = m.end()
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                found["card"].append(m.span())

    def plus(at: int) -> None:
        if at >= free["phone"] and (m := _PHONE.match(text, at)):
            free["phone"] = m.end()
            if 9 <= sum(c in _DIGITS for c in m[0]) <= 15:
                found["phone"].append(m.span())

    def scheme(end: int) -> None:
        at = start = end - 2
        while start > free["url"] and text[start - 1] in _SCHEME:
            start -= 1
        while start < at and not text[start].isalpha():  # a scheme begins with a letter
            start += 1
        if at - start >= 2 and (m := _AUTHORITY.match(text, end + 1)):
            found["url"].append((start, m.end()))
            free["url"] = m.end()

    def cue(end: int) -> None:
        if end + 1 >= free["account"] and (m := _ACCOUNT.match(text, end + 1)):
            # what fails as a whole has no part that doesn't: the next cue is looked at behind it
            free["account"] = m.end()
            if sum(c in _DIGITS for c in m[1]) >= 4 and len(m[1]) >= 6:
                found["account"].append(m.span(1))

    for end, word in anchors.iter(text):
        if word in _DIGITS:
            digit(end)
        elif word == "@":
            email(end)
        elif word == "+":
            plus(end)
        elif word == "://":
            scheme(end)
        else:
            cue(end)
    return [(k, a, z) for k in KINDS for a, z in found[k]]


def digest(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = automaton()
        for batch in batches:
            counts, hashes, said = [], [], []
            for value in batch.column(1):
                found = spans(value.as_py() or "", anchors)
                base = [x for x in found if x[0] in BASE_KINDS]
                counts.append([sum(x[0] == k for x in base) for k in BASE_KINDS])
                hashes.append(hashlib.sha256(",".join(f"{k}:{a}:{z}" for k, a, z in base).encode()).hexdigest())
                said.append(",".join(f"{k}:{a}:{z}" for k, a, z in found))
            by_kind = list(zip(*counts, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in by_kind), pa.array(hashes, pa.string()), pa.array(said, pa.string())], ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text")), run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def find_spans(docs: DataFrame, column: str = "text", out: str = "pii") -> DataFrame:
    """Add an array of (kind, start, end, value) to docs; a column named like ``out`` is replaced."""

    @F.pandas_udf("array<struct<kind: string, start: int, end: int, value: string>>")
    def find(values: pd.Series) -> pd.Series:
        anchors = automaton()
        return values.map(lambda x: [{"kind": k, "start": a, "end": z, "value": (x or "")[a:z]} for k, a, z in spans(x or "", anchors)])

    return docs.withColumn(out, find(F.col(column)))
