"""Personal data with offset-preserving deobfuscation.

Base patterns run on the text itself. Texts that show a trigger also pass a chain of transducers, each of
which rewrites characters and keeps, for every output character, the source span it came from:
homoglyphs -> ASCII, spelled digits -> digits, "at"/"dot" disguises -> "@"/".". The same patterns run on the
normalised text and the spans found there are mapped back to source characters.
"""
from __future__ import annotations

import hashlib
import re
import unicodedata

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from panelforge.llm.common import free_name, ship_code

KINDS = ("email", "ip", "card", "phone")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")

# Letters of other scripts that look like the Latin letter they stand for.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d",
    "һ": "h", "ӏ": "l", "ԛ": "q", "ԝ": "w", "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O",
    "Р": "P", "С": "C", "Т": "T", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S", "α": "a", "ο": "o", "ν": "v", "ρ": "p",
    "ι": "i", "κ": "k", "τ": "t", "υ": "u", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K",
    "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ı": "i", "ɡ": "g", "ɑ": "a",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "․": ".", "。": ".", " ": " ", " ": " ", " ": " ",
}
# Characters without width, deleted.
INVISIBLE = "­​‌‍⁠﻿"
# Spelled digits (English, Spanish, German, French).
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6",
    "seven": "7", "eight": "8", "nine": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7",
    "ocho": "8", "nueve": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7",
    "acht": "8", "neun": "9",
    "zéro": "0", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
}
REPEATS = {"double": 2, "triple": 3}
_ODD = "".join(LOOKALIKES) + INVISIBLE
_ODD_CHAR = re.compile(f"[{re.escape(_ODD)}！-～٠-٩۰-۹\U0001d400-\U0001d7ff]")
_WORDS = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
_ONE = rf"(?:(?:double|triple)[\x20-]+)?(?:{_WORDS})\b|[0-9]+"
_DOT_WORDS = "dot|point|punto|punkt"
_BRACKET_DOT = rf"[\[({{<][\x20]*(?:{_DOT_WORDS}|\.)[\x20]*[\])}}>]"
_SPELLED = re.compile(rf"(?i)(?<!\w)(?:(?:plus|\+)[\x20-]*)?(?:{_ONE})(?:(?:[\x20,-]|{_BRACKET_DOT}|[\x20](?:{_DOT_WORDS})[\x20])+"
                      rf"(?:{_ONE}))+(?!\w)")
#: What a run of spelled digits holds besides numerals and separators.
_FORM = re.compile(rf"(?i)\b(?:{_WORDS}|plus)\b|{_BRACKET_DOT}|[\x20](?:{_DOT_WORDS})[\x20]")
_BRACKETED = re.compile(rf"(?i){_BRACKET_DOT}")
_SPELLED_HINT = re.compile(rf"(?i)\b(?:{_WORDS}|double|triple|plus)[\x20,-]+(?:{_WORDS}|double|triple|dot|point)\b")
_SPOKEN = frozenset(DIGIT_WORDS) | frozenset(_DOT_WORDS.split("|")) | {"plus"}
_PART = re.compile(rf"(?i)\b(double|triple)\b|\b({_WORDS})\b|\b(plus)\b|([\x20](?:{_DOT_WORDS})[\x20]|{_BRACKET_DOT})|([0-9]+|\+)|(.)",
                   re.S)
_AT = r"[\x20]*(?:[\[({<][\x20]*(?:at|@|arroba|chez|bei)[\x20]*[\])}>])[\x20]*"
_DOT = r"[\x20]*(?:[\[({<][\x20]*(?:dot|\.|punto|punkt|point)[\x20]*[\])}>])[\x20]*"
_SPOKEN_DOT = r"[\x20]+(?:dot|punto|punkt|point)[\x20]+"
_LABEL = r"[A-Za-z0-9-]+"
_DISGUISE = re.compile(
    rf"(?i)(?<![A-Za-z0-9._%+-])(?P<local>[A-Za-z0-9_%+-]+(?:(?:\.|{_DOT}|{_SPOKEN_DOT})[A-Za-z0-9_%+-]+)*)"
    rf"(?P<at>{_AT}|@|[\x20]+(?:at|arroba)[\x20]+)"
    rf"(?P<host>{_LABEL}(?:(?:\.|{_DOT}|{_SPOKEN_DOT}){_LABEL})+)")
_DISGUISE_HINT = re.compile(r"(?i)[\[({<]\x20*(?:at|@|dot|\.|arroba|chez|bei|punto|punkt|point)\x20*[\])}>]"
                            r"|\x20(?:dot|punto|punkt|point)\x20")
_TOKEN = re.compile(r"\w+")
_TOP_LABEL = re.compile(r"(?<![A-Za-z0-9-])[A-Za-z]{2,}\Z")
_DOT_FORMS = re.compile(rf"(?i){_DOT}|{_SPOKEN_DOT}")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def find(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the patterns, leftmost and non-overlapping per kind; failing matches drop."""
    out = []
    if "@" in text:
        out += [(0, m.start(), m.end()) for m in EMAIL.finditer(text)]
    if not _DIGIT.search(text):
        return out
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        if 16 <= m.end() - m.start():
            digits = _NOT_DIGIT.sub("", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def _spells_digits(text: str) -> bool:
    """Whether a run of digits holds a digit word or a dot form; most texts fail the cheap test for any such word."""
    if _SPOKEN.isdisjoint(_TOKEN.findall(text.casefold())) and not _BRACKETED.search(text):
        return False
    return any(_FORM.search(run[0]) for run in _SPELLED.finditer(text))


class Tape:
    """A text under rewriting: its characters, the source span of each, and which were rewritten."""

    def __init__(self, text: str):
        self.text = text
        self.start = range(len(text))
        self.end = range(1, len(text) + 1)
        self.touched = bytes(len(text))

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace [a, b) by a string for each edit (ascending, disjoint); every new character takes the
        source span of the whole replaced stretch."""
        if not edits:
            return
        text, start, end, touched, at = [], [], [], bytearray(), 0
        for a, b, new in edits:
            text.append(self.text[at:a])
            start += self.start[at:a]
            end += self.end[at:a]
            touched += self.touched[at:a]
            text.append(new)
            start += [self.start[a]] * len(new)
            end += [self.end[b - 1]] * len(new)
            touched += b"\1" * len(new)
            at = b
        text.append(self.text[at:])
        start += self.start[at:]
        end += self.end[at:]
        touched += self.touched[at:]
        self.text, self.start, self.end, self.touched = "".join(text), start, end, bytes(touched)


def _folded(word: str) -> str:
    """Lower case as the patterns fold it: they also take a long s and a dotless i."""
    return word.casefold().replace("\u0131", "i").replace("\u0307", "")


def _plain(c: str) -> str:
    """ASCII stand-in of a look-alike, wide, styled or foreign digit character; empty if invisible."""
    if c in INVISIBLE:
        return ""
    return LOOKALIKES.get(c) or unicodedata.normalize("NFKC", c) if not c.isdecimal() else str(unicodedata.decimal(c))


def _digit_edits(text: str, every: bool = True) -> list[tuple[int, int, str]]:
    """Digits and single dots for the words, dot forms and separators of each run of spelled digits.

    Without ``every``, runs of numerals alone stay as they are, and so does a comma between a numeral and a word.
    """
    edits = []
    for run in _SPELLED.finditer(text):
        if not every and not _FORM.search(run[0]):
            continue
        times, pending = 1, None
        last, commas = "", []   # kind of the last digit; commas since then
        for m in _PART.finditer(text, run.start(), run.end()):
            double, word, plus, dot, digits, _ = m.groups()
            kind = "word" if word or double else "numeral" if digits and digits != "+" else ""
            if kind:
                if every or kind == last:
                    edits += [(a, a + 1, "") for a in commas]
                last, commas = kind, []
            if double:
                times, pending = REPEATS[double.casefold()], m.start()
            elif word:
                edits.append((m.start() if pending is None else pending, m.end(), DIGIT_WORDS[_folded(word)] * times))
                times, pending = 1, None
            elif plus:
                edits.append((m.start(), m.end(), "+"))
            elif dot:
                edits.append((m.start(), m.end(), "."))
            elif m[0] == "," and pending is None:
                commas.append(m.start())
            elif m[0] in " -" and pending is None:
                edits.append((m.start(), m.end(), ""))
    return sorted(edits)


def _disguise_edits(text: str) -> list[tuple[int, int, str]]:
    """At/dot forms of disguised addresses. A spoken, unbracketed "at" counts only with a dot form."""
    edits = []
    for m in _DISGUISE.finditer(text):
        at, host = m["at"].strip(), m["host"]
        if at.lower() in ("at", "arroba") and not _DOT_FORMS.search(host):
            continue
        if at != "@" and not _TOP_LABEL.search(host):
            continue
        stretch = [(d.start(), d.end(), ".") for d in _DOT_FORMS.finditer(text, m.start("local"), m.end("local"))]
        if at != "@" or m["at"] != "@":
            stretch.append((m.start("at"), m.end("at"), "@"))
        stretch += [(d.start(), d.end(), ".") for d in _DOT_FORMS.finditer(text, m.start("host"), m.end("host"))]
        edits += stretch
    return edits


def spans(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base spans, all spans) as (kind, start, end), ordered by kind, then start.

    A span from the normalised text is added when it holds a rewritten character and no base span of its
    kind covers it. Base spans always stay. Where digit words do not follow each other, a complete address or
    card of the base spans is not extended by the numbers around it.
    """
    text = text or ""
    base = sorted(find(text))
    odd = not text.isascii() and _ODD_CHAR.search(text)
    spelled = _spells_digits(text)
    disguised = odd or _DISGUISE_HINT.search(text)
    if not (odd or spelled or disguised):
        return base, base
    tape = Tape(text)
    if odd:
        tape.rewrite([(m.start(), m.end(), _plain(m[0])) for m in _ODD_CHAR.finditer(text)])
    every = bool(odd) or spelled and _SPELLED_HINT.search(text) is not None
    if spelled or odd:
        tape.rewrite(_digit_edits(tape.text, every))
    tape.rewrite(_disguise_edits(tape.text))
    if not any(tape.touched) and len(tape.text) == len(text):
        return base, base
    found = set(base)
    for kind, a, b in find(tape.text):
        s, e = tape.start[a], tape.end[b - 1]
        rewritten = any(tape.touched[a:b]) or e - s != b - a
        if not rewritten or any(k == kind and s >= x and e <= y for k, x, y in base):
            continue
        if every or KINDS[kind] not in ("ip", "card") or not any(k == kind and s <= x and y <= e for k, x, y in base):
            found.add((kind, s, e))
    return base, sorted(found)


def render(items: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in items)


def masked(text: str | None, items: list[tuple[int, int, int]]) -> str | None:
    """The text with each stretch of (possibly overlapping) spans replaced by its first kind's mark."""
    if text is None or not items:
        return text
    out, at = [], 0
    merged: list[list[int]] = []
    for kind, a, b in sorted(items, key=lambda x: (x[1], -x[2])):
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], b)
        else:
            merged.append([kind, a, b])
    for kind, a, b in merged:
        out += [text[at:a], f"<{KINDS[kind].upper()}>"]
        at = b
    return "".join(out) + text[at:]


_RESULT = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, clean string"


def _row(text: str | None, clean: bool):
    base, every = spans(text)
    counts = [0] * len(KINDS)
    for k, _, _ in every:
        counts[k] += 1
    digest = hashlib.sha256(render(base).encode()).hexdigest()
    return (*counts, digest, render(every), masked(text, every) if clean else None)


def _columns(clean: bool):
    @pandas_udf(_RESULT)
    def scan(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_row(t, clean) for t in texts],
                            columns=[c.split()[0] for c in _RESULT.split(", ")])
    return scan


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` per row of ``docs``.

    Offsets are code points, ends exclusive; counts are of all spans. A null text counts as empty (zero
    counts, the hash of the empty string, empty spans). One row per input row, so repeated rows and null
    ids stay as they are; other columns are not read; an empty table gives an empty result. Texts are
    scanned whole.
    """
    ship_code(docs.sparkSession)
    hit = docs.select(F.col(id_col).alias("doc_id"), _columns(False)(F.col(text_col)).alias("p"))
    return hit.select("doc_id", "p.n_email", "p.n_ip", "p.n_card", "p.n_phone", "p.base_sha256", "p.spans")


def mask_pii(docs: DataFrame, text_col: str = "text", count_col: str = "n_chars") -> DataFrame:
    """``docs`` with found spans replaced by ``<EMAIL>``, ``<IP>``, ``<CARD>`` or ``<PHONE>``.

    Same columns and rows; ``count_col`` (if there) follows a changed text. Null texts stay null.
    """
    ship_code(docs.sparkSession)
    clean = free_name(docs, "clean")
    out = docs.withColumn(clean, _columns(True)(F.col(text_col))["clean"])
    new = {text_col: F.col(clean)}
    if count_col in docs.columns:
        changed = ~F.col(clean).eqNullSafe(F.col(text_col))
        new[count_col] = F.when(changed, F.length(clean)).otherwise(F.col(count_col)).cast(docs.schema[count_col].dataType)
    return out.withColumns(new).select(*docs.columns)
