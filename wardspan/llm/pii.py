"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors: at-signs, a plus before a digit, the
places where digits meet, schemes and identifier cues. A parser for each kind
grows the match from its anchor and validates it. Parsers are fixed rules over
the characters next to the anchor, so a text is read once whatever it holds.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds in the order of ties; the first four are the base, the others the method's own.
KINDS = ("email", "ip", "card", "phone", "login", "iban")
SPANS = "array<struct<kind:string,start:int,end:int>>"
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGITS = "0123456789"
_NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOGIN = re.compile(r"[^\s/@:]+:[^\s/@]+@[A-Za-z0-9.-]*[A-Za-z0-9]")
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_IBAN = re.compile(r"[\s:#=]{0,4}(?:no\.?|number|nr\.?)?[\s:#=]{0,4}([A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])")


_automata: dict = {}


def _anchors():
    if "anchors" in _automata:
        return _automata["anchors"]
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for a in _DIGITS:
        automaton.add_word(f"+{a}", ("phone", 2))
        for b in _DIGITS:
            automaton.add_word(f"{a}.{b}", ("ip", 3))
            for gap in ("", " ", "-"):
                automaton.add_word(f"{a}{gap}{b}", ("card", 2 + len(gap)))
    automaton.add_word("@", ("email", 1))
    automaton.add_word("://", ("login", 3))
    for cue in ("IBAN", "iban", "Iban"):
        automaton.add_word(cue, ("iban", 4))
    automaton.make_automaton()
    _automata["anchors"] = automaton
    return automaton


def _luhn(digits: str) -> bool:
    total = 0
    for k, digit in enumerate(reversed(digits)):
        value = int(digit) * (2 if k % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _iban(code: str) -> bool:
    code = code.replace(" ", "")
    if not 15 <= len(code) <= 34:
        return False
    turned = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def find(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all personal data in ``text``, by start and then kind."""
    found = []
    done = dict.fromkeys(KINDS, 0)  # the next match of a kind starts here or later
    for last, (kind, size) in _anchors().iter(text):
        at = last - size + 1
        if at < done[kind]:
            continue
        if kind == "email":
            start = at
            while start > done[kind] and text[start - 1] in _LOCAL:
                start -= 1
            match = _DOMAIN.match(text, at + 1) if start < at else None
            if match:
                done[kind] = match.end()
                found.append((kind, start, match.end()))
        elif kind == "ip":
            start = at
            while start > done[kind] and text[start - 1] in _DIGITS:
                start -= 1
            chain = _NUMBERS.match(text, start)
            done[kind] = chain.end()
            parts, begin = chain.group().split("."), start
            for k in range(0, len(parts) - 3, 4):
                end = begin + sum(map(len, parts[k : k + 4])) + 3
                if all(map(_octet, parts[k : k + 4])):
                    found.append((kind, begin, end))
                begin = end + 1
        elif kind == "card":
            match = _CARD.match(text, at)
            done[kind] = match.end()
            digits = match.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and _luhn(digits):
                found.append((kind, at, match.end()))
        elif kind == "phone":
            match = _PHONE.match(text, at)
            if match:
                done[kind] = match.end()
                if 10 <= sum(c in _DIGITS for c in match.group()) <= 15:
                    found.append((kind, at, match.end()))
        elif kind == "login":
            start = at
            while start > done[kind] and text[start - 1] in _SCHEME:
                start -= 1
            match = _LOGIN.match(text, last + 1) if start < at else None
            if match:
                done[kind] = match.end()
                found.append((kind, start, match.end()))
        else:
            match = _IBAN.match(text, last + 1)
            if match and _iban(match.group(1)):
                done[kind] = match.end(1)
                found.append((kind, match.start(1), match.end(1)))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with every span, overlapping ones as one, as ``[KIND]`` of the first."""
    parts, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            parts += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def _finder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans, clean = [], []
        for text in batch.column(1).to_pylist():
            own = find(text or "")
            spans.append([{"kind": k, "start": a, "end": b} for k, a, b in own])
            clean.append(redact(text, own) if own else text)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(spans, _SPAN_TYPE), pa.array(clean, pa.string())],
            names=["id", "text", "spans", "redacted"],
        )


def redact_column(text_col: str) -> Column:
    """The text with personal data replaced by its kind; null stays null."""

    @F.pandas_udf("string")
    def redacted(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: redact(t, find(t)), na_action="ignore")

    return redacted(F.col(f"`{text_col}`"))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``<id_col>``, ``<text_col>``, spans, redacted.

    ``spans`` are (kind, start, end) in code points, end exclusive, by start and
    then kind. Base kinds, leftmost and non-overlapping per kind: email, ip
    (parts up to 255), card (14 to 19 digits that pass Luhn) and phone (10 to 15
    digits). The method adds logins in addresses (scheme://user:word@host) and
    account numbers after an IBAN cue whose check digits hold. ``redacted`` is
    the text with spans replaced by their kind. A null text has no spans and
    stays null; null ids and repeated rows are handled like any row; other
    columns are ignored; an empty table gives no rows. Whole texts are read.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    rows = rows.mapInArrow(_finder, f"id {kind}, text string, spans {SPANS}, redacted string")
    return rows.withColumnsRenamed({"id": id_col, "text": text_col})
