"""Personal identifiers in texts, plain or disguised."""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import ahocorasick
from pyspark.sql import DataFrame

from cohort_engine.llm.spans import Span, digest, find_spans

KINDS = ("email", "ip", "card", "phone")

# The patterns of the identifiers, and the limits on their matches. The
# quantifiers that can't profit from giving characters back don't (++), and a number
# is begun at its first digit only, so that long runs take linear time.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Letters that look like Latin ones, and the Latin ones below them.
LOOKALIKES = str.maketrans(
    "АВЕЅІЈКМНОРСТУХаеіјорсухѕԁһԛԝ" "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧινορ" "․。﹫",
    "ABESIJKMHOPCTYXaeijopcyxsdhqw" "ABEZHIKMNOPTYXivop" "..@",
)
# Characters without width.
INVISIBLE = "­​‌‍⁠﻿"
# Digits in English, German, French and Spanish.
SPELLED = {
    word: str(value)
    for words in (
        "zero one two three four five six seven eight nine",
        "null eins zwei drei vier fünf sechs sieben acht neun",
        "zéro un deux trois quatre cinq six sept huit neuf",
        "cero uno dos tres cuatro cinco seis siete ocho nueve",
    )
    for value, word in enumerate(words.split())
}
# Spelled digits count in runs that have so many of them, digits between them or not.
SPELLED_IN_A_ROW = 3


def _compatible() -> str:
    """As a character class: all characters that Unicode has for compatibility with ASCII
    ones (wide, circled, raised, mathematical, ligatures, spaces)."""
    codes = [*range(0x80, 0x10000), *range(0x1D400, 0x1D800), *range(0x1F100, 0x1F200)]
    parts: list[list[int]] = []
    for code in codes:
        char = chr(code)
        if not 0xD800 <= code < 0xE000 and unicodedata.normalize("NFKC", char).isascii():
            if parts and parts[-1][1] == code - 1:
                parts[-1][1] = code
            else:
                parts.append([code, code])
    return "".join(f"{re.escape(chr(low))}-{re.escape(chr(high))}" for low, high in parts)


_STRANGE = re.compile(
    f"[{INVISIBLE}" + "".join(map(chr, LOOKALIKES)) + f"{_compatible()}]|(?![0-9])\\d"
)
_WORD = "|".join(sorted(SPELLED, key=len, reverse=True))
# Between spelled digits: space of any kind, also over a line break, or a sign with space.
_SIGN = "[-,;/.]"
_GAP = rf"(?:\s{{1,3}}dot\s{{1,3}}|\s{{0,2}}{_SIGN}\s{{0,3}}|\s{{1,3}})"
_DIGIT = rf"(?:(?:{_WORD})(?![^\W\d_])|[0-9])"
_SPELLED_RUN = re.compile(rf"(?<!\w)(?:plus\s{{1,3}})?{_DIGIT}(?:{_GAP}?{_DIGIT})+", re.IGNORECASE)
_IN_RUN = re.compile(
    rf"(?P<plus>plus\s{{1,3}})|(?P<word>{_WORD})(?![^\W\d_])|(?P<dot>\s{{1,3}}dot\s{{1,3}})"
    rf"|(?P<space>(?<=\w)\s{{0,2}}{_SIGN}\s{{0,3}}(?=\w)|(?<=\w)\s{{2,3}}(?=\w)|(?<=\w)[^\S\x20](?=\w))",
    re.IGNORECASE,
)
_BRACKETED = re.compile(
    r"[\[({<][\x20\t]{0,3}(?P<what>at|dot|@|\.)[\x20\t]{0,3}[\])}>][\x20\t]{0,3}", re.IGNORECASE
)
# Ends of domains that a disguise in underscores or hyphens needs, which
# names in program text have as well.
_ENDS = "com|net|org|edu|gov|info|io|eu|de|uk|fr|es"
_BARE_AT = re.compile(
    r"\s{1,3}at\s{1,3}(?=[A-Za-z0-9-]{1,63}(?:\s{1,3}dot\s{1,3}|\.)[A-Za-z]{2})"
    rf"|[_-]at[_-](?=[A-Za-z0-9-]{{1,63}}?(?:[_-]dot[_-]|\.)(?:{_ENDS})\b)",
    re.IGNORECASE,
)
_BARE_DOT = re.compile(
    rf"\s{{1,3}}dot\s{{1,3}}(?=[A-Za-z]{{2}})|[_-]dot[_-](?=(?:{_ENDS})\b)", re.IGNORECASE
)
# What may stand between spelled digits, as a space.
_GAPS_AS_SPACE = str.maketrans(dict.fromkeys("-,;/._", " "))


def _neighbours() -> ahocorasick.Automaton:
    """Finds two spelled digits side by side, without which there is no run of three.

    In a run of three with digits between them no two need to be side by side, so a
    spelled digit beside a digit counts as well. Each gap is one space here.
    """
    automaton = ahocorasick.Automaton()
    for word in SPELLED:
        for gap in ("", " ", " dot "):
            for other in (*SPELLED, *"0123456789"):
                # Without a gap only a digit continues a run.
                if gap or other.isdigit():
                    automaton.add_word(word + gap + other, 1)
    automaton.make_automaton()
    return automaton


_PAIRS = _neighbours()


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @ the characters before and the domain after it."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    """Whether the check digit fits."""
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def plain_identifiers(text: str) -> Iterator[tuple[int, int, int]]:
    """(number of the kind, start, end); leftmost, not overlapping within a kind."""
    for start, end in emails(text):
        yield 0, start, end
    for m in IP.finditer(text):
        parts = [part.lstrip("0") or "0" for part in m[0].split(".")]
        if all(len(part) <= 3 and int(part) <= 255 for part in parts):
            yield 1, m.start(), m.end()
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = re.sub("[^0-9]", "", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                yield 2, m.start(), m.end()
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum(map(str.isdigit, m[0])) <= 15:
                yield 3, m.start(), m.end()


class Normal:
    """A text with replacements, and the source places of its characters."""

    def __init__(self, text: str):
        self.text, self.starts, self.ends = text, None, None

    def replace(self, edits: list[tuple[int, int, str]]) -> None:
        """Apply (start, end, new text); ordered and not overlapping."""
        if not edits:
            return
        parts, cuts, origins, at, length = [], [], [], 0, 0
        for start, end, new in [*edits, (len(self.text), len(self.text), "")]:
            for piece, source, exact in (
                (self.text[at:start], (at, start), True),
                (new, (start, end), False),
            ):
                if piece:
                    cuts.append(length)
                    origins.append((*source, exact))
                    parts.append(piece)
                    length += len(piece)
            at = end
        before = self.source
        self.text = "".join(parts)

        def source(start: int, end: int) -> tuple[int, int]:
            first, last = bisect_right(cuts, start) - 1, bisect_right(cuts, end - 1) - 1
            left, right = origins[first][0], origins[last][1]
            if origins[first][2]:
                left += start - cuts[first]
            if origins[last][2]:
                right = origins[last][0] + end - cuts[last]
            return before(left, right)

        self.source = source

    def source(self, start: int, end: int) -> tuple[int, int]:
        """The source span of the characters from ``start`` to ``end``."""
        return start, end


def _plain_character(char: str) -> str:
    """The ASCII character that a strange one stands for."""
    if char in INVISIBLE:
        return ""
    digit = unicodedata.digit(char, None)
    if digit is not None:
        return str(digit)
    plain = unicodedata.normalize("NFKC", char).translate(LOOKALIKES)
    return plain if plain.isascii() else char


def normalised(text: str) -> Normal:
    """Homoglyphs, then spelled digits, then at and dot disguises replaced."""
    normal = Normal(text)
    if not text.isascii():
        normal.replace(
            [
                (m.start(), m.end(), plain)
                for m in _STRANGE.finditer(text)
                if (plain := _plain_character(m[0])) != m[0]
            ]
        )
    # Without line breaks, signs and double spaces, to see quickly what is not there.
    plain = " ".join(normal.text.lower().translate(_GAPS_AS_SPACE).split())
    if next(_PAIRS.iter(plain), None):
        normal.replace(_spelled(normal.text))
    if any(mark in normal.text for mark in "[({<"):
        normal.replace(_bracketed(normal.text))
    if " at " in plain:
        normal.replace([(m.start(), m.end(), "@") for m in _BARE_AT.finditer(normal.text)])
    if " dot " in plain and "@" in normal.text:
        normal.replace([(m.start(), m.end(), ".") for m in _BARE_DOT.finditer(normal.text)])
    return normal


def _spelled(text: str) -> list[tuple[int, int, str]]:
    """Edits that turn runs of spelled digits into digits, and gaps inside into a space.

    A gap with a point stays a point, since addresses have them.
    """
    edits = []
    for run in _SPELLED_RUN.finditer(text):
        inner = list(_IN_RUN.finditer(text, run.start(), run.end()))
        if sum(1 for m in inner if m["word"]) >= SPELLED_IN_A_ROW:
            for m in inner:
                if m["space"]:
                    new = "." if "." in m["space"] else "-" if "-" in m["space"] else " "
                else:
                    new = "+" if m["plus"] else "." if m["dot"] else SPELLED[m["word"].lower()]
                edits.append((m.start(), m.end(), new))
    return edits


def _bracketed(text: str) -> list[tuple[int, int, str]]:
    """Edits that turn at and dot in brackets, with the spaces around, into their signs."""
    edits, done = [], 0
    for m in _BRACKETED.finditer(text):
        start = m.start()
        while start > max(done, m.start() - 3) and text[start - 1] in " \t":
            start -= 1
        edits.append((start, m.end(), "@" if m["what"].lower() in ("at", "@") else "."))
        done = m.end()
    return edits


def find_identifiers(text: str) -> list[Span]:
    """Plain matches and those of the normalised text, by kind, then place.

    A span of the normalised text covers the source characters, disguise included, that
    its characters stand for. One that a plain match has already is not repeated.
    """
    found = {span: "" for span in plain_identifiers(text)}
    normal = normalised(text)
    if normal.text != text:
        for kind, start, end in plain_identifiers(normal.text):
            found.setdefault((kind, *normal.source(start, end)), "disguised")
    return [(KINDS[kind], start, end, found[kind, start, end]) for kind, start, end in sorted(found)]


def scan_identifiers(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """All personal identifiers of each text, with spans in the text as it stands.

    Texts are taken whole, one by one in the task that reads them. A null or empty text
    has no spans; repeated rows are searched each; an empty table gives an empty result.
    Other columns are ignored. Result, a row for each input row: id, spans.
    """
    return find_spans(docs, find_identifiers, id_col, text_col)


def identifiers_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and hash of the plain matches, and all spans as a string."""
    return digest(found, id_col, KINDS)
