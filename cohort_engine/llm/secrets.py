"""Secrets in texts and in the encoded layers inside them."""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import zstandard
from pyspark.sql import DataFrame

from cohort_engine.llm.spans import Span, ascii_class, digest, find_spans, longest_run

KINDS = ("assign", "access", "hex")

# The patterns of the three kinds and the least lengths of their matches.
ASSIGN = re.compile(
    r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # 20 or more in all
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGNED = 6

# So many bytes of one text are unpacked in all, over all layers; a stretch that would need
# more is searched up to there and reported as a span of kind "opaque". Without an end,
# streams that unpack to themselves or to ever longer ones would never be done.
MAX_UNPACKED = 4 << 30
# Streams right inside one another; beyond, "opaque".
MAX_NESTED = 64

# Unpacked bytes are searched in pieces of this size. Each piece is searched with the end
# of the one before; a base64 run at its end waits for the next, up to MAX_HELD bytes.
PIECE = 4 << 20
OVERLAP = 1 << 16
MAX_HELD = 16 << 20
# Packed bytes are fed by so many, which is what is lost before a fault.
FEED = 64
# A zstd frame with a window over this is unpacked up to so many bytes.
MAX_WINDOW = 256 << 20

# Marks of gzip, bz2, zstd and zlib, anywhere and, less strict, at the start of the bytes.
_ZLIB = bytes(b for b in range(256) if (0x7800 + b) % 31 == 0)
MAGIC = re.compile(
    rb"\x1f\x8b\x08|BZh[1-9](?:1AY&SY|\x17rE8P\x90)|\x28\xb5\x2f\xfd|\x78[\x01\x5e\x9c\xda]"
)
FIRST = re.compile(rb"\x1f\x8b|BZh[0-9]|\x28\xb5\x2f\xfd|\x78[" + re.escape(_ZLIB) + rb"]")
_LONGEST_MAGIC = 10
# zlib's mark has two bytes. Inside other bytes it counts as one if so much unpacks.
_ZLIB_LEAST = 1_000

ESCAPE = re.compile(
    r"(?P<url>(?:%[0-9A-Fa-f]{2})+)"
    r"|\\u\{(?P<braced>[0-9A-Fa-f]{1,6})\}|\\u(?P<u>[0-9A-Fa-f]{4})|\\x(?P<x>[0-9A-Fa-f]{2})"
    r"|&#x(?P<hex>[0-9A-Fa-f]{1,6});|&#(?P<dec>[0-9]{1,7});"
)
# Base64 digits, also over line breaks (written out or as "\\n") and the indent after them.
_BREAK = r"(?:\r?\n|(?:\\r)?\\n)[\t\x20]*+"
BASE64 = re.compile(rf"[A-Za-z0-9+/_-]++(?:{_BREAK}[A-Za-z0-9+/_-]++)*+={{0,2}}")
BREAK = re.compile(_BREAK)
LEAST_DIGITS = 16
# Escapes on one line with no more characters between them may stand for bytes.
APART = 256

# Text in two bytes a character, as far as it is ASCII.
WIDE = re.compile(r"(?:[\t\n\r\x20-\x7e]\x00){8,}[\t\n\r\x20-\x7e]?")

# Texts without these can't match, which is found out faster than by the patterns.
_KEYS = ("password", "passwd", "secret", "token", "api_key", "apikey")
_HEX_CLASS = ascii_class("0123456789abcdef")
_RUN_CLASS = ascii_class(
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-\r\n\\"
)
_STANDARD = str.maketrans("-_", "+/")


def _longest_run(text: str, of: np.ndarray) -> int:
    return longest_run(np.frombuffer(text.encode(), np.uint8), of)


def plain_secrets(text: str) -> Iterator[tuple[int, int, int]]:
    """(start, number of the kind, end); leftmost, not overlapping within a kind."""
    lower = text.lower()
    if any(key in lower for key in _KEYS):
        for m in ASSIGN.finditer(text):
            if m.end(1) - m.start(1) >= ASSIGNED:
                yield m.start(), 0, m.end()
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            yield m.start(), 1, m.end()
    if _longest_run(text, _HEX_CLASS) >= 24:
        for m in HEX.finditer(text):
            yield m.start(), 2, m.end()


class Layer:
    """A decoded text and where its characters come from.

    ``cuts[i]`` is the place in the layer from which on characters come from the source
    span ``spans[i]``; where ``exact[i]`` is set each character is one of the source.
    """

    def __init__(self, text: str, cuts: list[int], spans: list[tuple[int, int]], exact: list[bool]):
        self.text, self.cuts, self.spans, self.exact = text, cuts, spans, exact

    def source(self, start: int, end: int) -> tuple[int, int]:
        """The source span of the characters from ``start`` to ``end``."""
        first = bisect_right(self.cuts, start) - 1
        last = bisect_right(self.cuts, end - 1) - 1
        left, right = self.spans[first][0], self.spans[last][1]
        if self.exact[first]:
            left += start - self.cuts[first]
        if self.exact[last]:
            right = self.spans[last][0] + end - self.cuts[last]
        return left, right


class _Builder:
    def __init__(self, parent: Layer):
        self.parent, self.parts, self.length = parent, [], 0
        self.cuts, self.spans, self.exact = [], [], []

    def add(self, text: str, start: int, end: int) -> None:
        """``text`` stands for the parent's characters from ``start`` to ``end``."""
        if not text:
            return
        parent = self.parent
        if end - start == len(text) and parent.text[start:end] == text:
            # Unchanged: split where the parent's own origin changes.
            at = start
            while at < end:
                i = bisect_right(parent.cuts, at) - 1
                stop = min(end, parent.cuts[i + 1] if i + 1 < len(parent.cuts) else end)
                left, right = parent.source(at, stop)
                self._put(stop - at, (left, right), parent.exact[i])
                at = stop
        else:
            self._put(len(text), parent.source(start, end), False)
        self.parts.append(text)

    def _put(self, length: int, span: tuple[int, int], exact: bool) -> None:
        self.cuts.append(self.length)
        self.spans.append(span)
        self.exact.append(exact)
        self.length += length

    def layer(self) -> Layer:
        return Layer("".join(self.parts), self.cuts, self.spans, self.exact)


def _utf8(data: bytes) -> Iterator[tuple[str, int]]:
    """Characters and the number of bytes of each; bad bytes as U+FFFD."""
    at = 0
    while at < len(data):
        lead = data[at]
        size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        try:
            yield data[at : at + size].decode(), min(size, len(data) - at)
            at += size
        except UnicodeDecodeError:
            yield "�", 1
            at += 1


def _character(m: re.Match) -> str:
    digits = m["braced"] or m["u"] or m["x"] or m["hex"]
    code = int(digits, 16) if digits else int(m["dec"])
    return chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else "�"


def _unescaped(layer: Layer) -> Iterator[Layer]:
    """The text once unescaped, and each stretch of bytes that is no text as bytes.

    The text is unescaped as a whole, so that what is encoded over several lines with
    escapes in each stays in one piece.
    """
    text = layer.text
    if "%" not in text and "\\" not in text and "&#" not in text:
        return
    built, at, stretch = _Builder(layer), 0, []
    for m in ESCAPE.finditer(text):
        built.add(text[at : m.start()], at, m.start())
        if m["url"]:
            place = m.start()
            for char, size in _utf8(binascii.unhexlify(m["url"].replace("%", ""))):
                built.add(char, place, place + 3 * size)
                place += 3 * size
        else:
            built.add(_character(m), m.start(), m.end())
        if stretch and (m.start() - at > APART or "\n" in text[at : m.start()]):
            yield from _as_bytes(layer, stretch)
            stretch = []
        stretch.append(m)
        at = m.end()
    if at:
        yield from _as_bytes(layer, stretch)
        built.add(text[at:], at, len(text))
        yield built.layer()


class _Bytes(Layer):
    """Bytes, each as one character, in which packed streams may begin."""


def _as_bytes(layer: Layer, escapes: list[re.Match]) -> Iterator[_Bytes]:
    """The bytes that neighbouring escapes and the characters between them stand for.

    Nothing if they are text. What stands before and behind, up to the line's end, may
    belong to them: bytes that are printable need not be escaped.
    """
    strange = False
    for m in escapes:
        if m["url"]:
            strange |= any(int(m["url"][i + 1 : i + 3], 16) >= 128 for i in range(0, len(m["url"]), 3))
        else:
            strange |= 128 <= ord(_character(m)) < 256
    if not strange:
        return
    text = layer.text
    first, last = escapes[0].start(), escapes[-1].end()
    begin = max(text.rfind("\n", 0, first) + 1, first - _LONGEST_MAGIC)
    end = text.find("\n", last, last + APART)
    end = min(len(text), last + APART) if end < 0 else end
    built, at = _Builder(layer), begin
    for m in escapes:
        built.add(text[at : m.start()], at, m.start())
        if m["url"]:
            for place in range(m.start(), m.end(), 3):
                built.add(chr(int(text[place + 1 : place + 3], 16)), place, place + 3)
        else:
            built.add(_character(m), m.start(), m.end())
        at = m.end()
    # What is behind them need not be ASCII, but then it is no part of them.
    built.add(re.match(r"[\x00-\x7f]*", text[at:end])[0], at, end)
    found = built.layer()
    yield _Bytes(found.text, found.cuts, found.spans, found.exact)


class _Budget:
    """Bytes of a text that may still be unpacked."""

    def __init__(self):
        self.left = MAX_UNPACKED


def _magic(data: bytes, at: int, first: bool) -> re.Match | None:
    """The first mark of a packed stream from ``at`` on."""
    return (first and at == 0 and FIRST.match(data)) or MAGIC.search(data, at)


class _Stream:
    """A packed stream and those that follow right behind it, unpacked in pieces."""

    def __init__(self, data: bytes, at: int, more: Callable[[], bytes], budget: _Budget):
        self.data, self.at, self.more, self.budget = data, at, more, budget
        self.taken = self.failed = self.done = False
        self.size = 0
        self._start()

    def _start(self) -> None:
        head = self.data[self.at : self.at + 18]
        self.strict = head[:1] != b"x" and MAGIC.match(head) is not None
        self.limit, self.frame = None, 0
        if head[:2] == b"\x1f\x8b":
            self.tool = zlib.decompressobj(31)
        elif head[:1] == b"x":
            self.tool = zlib.decompressobj()
        elif head[:3] == b"BZh":
            self.tool = bz2.BZ2Decompressor()
        else:
            self.tool = zstandard.ZstdDecompressor(max_window_size=1 << 31).decompressobj()
            try:
                if zstandard.get_frame_parameters(head).window_size > MAX_WINDOW:
                    self.limit = MAX_WINDOW
            except zstandard.ZstdError:
                pass

    def _take(self) -> bool:
        piece = self.more()
        if piece:
            self.data, self.at, self.taken = self.data[self.at :] + piece, 0, True
        return bool(piece)

    def _step(self) -> bytes:
        """What a few more packed bytes unpack to."""
        if isinstance(self.tool, bz2.BZ2Decompressor) and not self.tool.needs_input:
            block = b""
        else:
            if self.at == len(self.data) and not self._take():
                raise EOFError
            block = self.data[self.at : self.at + FEED]
            self.at += len(block)
        if isinstance(self.tool, bz2.BZ2Decompressor):
            return self.tool.decompress(block, PIECE)
        return self.tool.decompress(block)

    def read(self) -> bytes:
        """The next bytes; none at the end."""
        parts, size = [], 0
        while size < PIECE and not self.done:
            try:
                out = self._step()
            except (zlib.error, OSError, EOFError, MemoryError, zstandard.ZstdError):
                self.failed = self.done = True
                break
            if len(out) > self.budget.left:
                out = out[: self.budget.left]
                self.budget.left = 0
                self.failed = self.done = True
            else:
                self.budget.left -= len(out)
            self.frame += len(out)
            if self.limit is not None and self.frame > self.limit:
                self.failed = self.done = True
            parts.append(out)
            size += len(out)
            if self.tool.eof and not self.failed:
                self.at -= len(self.tool.unused_data)
                while len(self.data) - self.at < _LONGEST_MAGIC and self._take():
                    pass
                if MAGIC.match(self.data, self.at):
                    self._start()
                else:
                    self.done = True
        self.size += size
        return b"".join(parts)

    def opaque(self, first: bool) -> bool:
        """Whether the stream, known by its mark, holds what couldn't be unpacked.

        Two bytes are a weak mark: then something must have been unpacked.
        """
        least = 1 if first else _ZLIB_LEAST
        return self.failed and (self.strict or self.size >= least)


def _windows(read: Callable[[], bytes], budget: _Budget, depth: int) -> Iterator[str | None]:
    """Texts to search in unpacked bytes and in streams inside them; None for "opaque".

    Bytes stand as one character each.
    """
    # Marks are sought from ``fresh`` on; up to ``shown`` the bytes were searched as text.
    data, fresh, shown, first = b"", 0, 0, True
    while True:
        piece = read()
        data += piece
        while m := _magic(data, fresh, first):
            begins, start = first and m.start() == 0, m.start()
            first = False
            if depth >= MAX_NESTED or not budget.left:
                yield None
                break
            inner = _Stream(data, start, read, budget)
            yield from _windows(inner.read, budget, depth + 1)
            if inner.opaque(begins):
                yield None
            if inner.failed and not inner.taken:
                fresh = start + 1
            else:
                if start > shown:
                    yield data[:start].decode("latin-1")
                data, fresh, shown = inner.data[inner.at :], 0, 0
        if not piece:
            if len(data) > shown:
                yield data.decode("latin-1")
            return
        first = first and len(data) < 4
        fresh = max(fresh, 0 if first else len(data) - _LONGEST_MAGIC + 1)
        tail = np.flatnonzero(~_RUN_CLASS[np.frombuffer(data, np.uint8)])
        hold = int(tail[-1]) + 1 if len(tail) else 0
        if len(data) - hold > MAX_HELD:
            yield None
            hold = len(data)
        if hold > shown:
            yield data[:hold].decode("latin-1")
            cut = max(0, hold - OVERLAP)
            data, shown, fresh = data[cut:], hold - cut, max(0, fresh - cut)


def _no_more() -> bytes:
    return b""


class _Run:
    """A base64 run, joined over its line breaks, with the places of its digits."""

    def __init__(self, m: re.Match):
        text, self.starts, self.places, parts = m[0].rstrip("="), [], [], []
        at = length = 0
        for gap in (*BREAK.finditer(text), None):
            stop = gap.start() if gap else len(text)
            self.starts.append(length)
            self.places.append(m.start() + at)
            parts.append(text[at:stop])
            length += stop - at
            at = gap.end() if gap else stop
        self.digits, self.end = "".join(parts).translate(_STANDARD), m.end()

    def place(self, digit: int) -> int:
        """The place of a digit in the text."""
        i = bisect_right(self.starts, digit) - 1
        return self.places[i] + digit - self.starts[i]

    def data(self, skip: int) -> bytes:
        """The bytes from digit ``skip`` on."""
        digits = self.digits[skip:]
        if len(digits) % 4 == 1:
            digits = digits[:-1]
        return base64.b64decode(digits + "=" * (-len(digits) % 4))


class _Decoded(Layer):
    """The bytes of a base64 run from digit ``skip`` on, each as one character.

    All patterns are ASCII, so that what the other bytes stand for doesn't matter.
    """

    def __init__(self, parent: Layer, run: _Run, skip: int, data: bytes):
        super().__init__(data.decode("latin-1"), [0], [(0, 0)], [False])
        self.parent, self.run, self.skip = parent, run, skip

    def source(self, start: int, end: int) -> tuple[int, int]:
        # The base64 digits that hold any bit of these bytes.
        first, last = self.skip + start * 8 // 6, self.skip - (-end * 8 // 6) - 1
        last = min(last, len(self.run.digits) - 1)
        return self.parent.source(self.run.place(first), self.run.place(last) + 1)


class _Narrow(Layer):
    """Every second character of a stretch."""

    def __init__(self, parent: Layer, start: int, end: int):
        super().__init__(parent.text[start:end:2], [0], [(0, 0)], [False])
        self.parent, self.start = parent, start

    def source(self, start: int, end: int) -> tuple[int, int]:
        stop = min(self.start + 2 * end, len(self.parent.text))
        return self.parent.source(self.start + 2 * start, stop)


def _narrowed(layer: Layer) -> Iterator[Layer]:
    """Texts in two bytes a character (UTF-16) inside decoded bytes."""
    if "\x00" in layer.text:
        for m in WIDE.finditer(layer.text):
            yield _Narrow(layer, m.start(), m.end())


def _packed(
    data: bytes, first: bool, span_from: Callable[[int], tuple[int, int]], budget: _Budget
) -> Iterator[Layer | tuple[int, int]]:
    """Pieces of the packed streams in some bytes; spans that don't unpack.

    ``first``: the bytes may begin with a stream by a weaker mark. ``span_from`` gives the
    source span of all bytes from one on.
    """
    at = 0
    while m := _magic(data, at, first):
        start = m.start()
        begins, first = first and start == 0, False
        span = span_from(start)
        stream = _Stream(data, start, _no_more, budget)
        for text in _windows(stream.read, budget, 1):
            yield span if text is None else Layer(text, [0], [span], [False])
        if stream.opaque(begins):
            yield span
        if not budget.left:
            return
        at = start + 1 if stream.failed else len(data) - (len(stream.data) - stream.at)


def _from_base64(
    layer: Layer, budget: _Budget
) -> Iterator[Layer | Iterator[Layer | tuple[int, int]]]:
    """Bytes behind base64 runs, and the pieces of what is packed in them.

    A run may be glued to letters before it, so that each digit of the first four may be
    the first of a group.
    """
    for m in BASE64.finditer(layer.text):
        if m.end() - m.start() < LEAST_DIGITS:
            continue
        run = _Run(m)
        if len(run.digits) < LEAST_DIGITS:
            continue
        for skip in range(4):
            data = run.data(skip)
            yield _Decoded(layer, run, skip, data)
            if _magic(data, 0, skip == 0):

                def span_from(byte: int, run=run, skip=skip) -> tuple[int, int]:
                    return layer.source(run.place(skip + byte * 8 // 6), run.end)

                yield _packed(data, skip == 0, span_from, budget)


def find_secrets(text: str) -> list[Span]:
    """Plain matches and those in decoded layers, by start, then kind, then end.

    A worklist holds the layers to search. Each is searched for secrets and for encoded
    stretches; what these decode to becomes a layer, packed bytes piece by piece when it
    is their turn. Layers seen before (same text from the same source span) are left out,
    so that the list runs empty: unescaping and base64 shorten a text, and what is
    unpacked is bounded.
    """
    found = {(start, kind, end): "" for start, kind, end in plain_secrets(text)}
    work, seen, budget = [Layer(text, [0], [(0, len(text))], [True])], set(), _Budget()

    def search(inner: Layer | tuple[int, int], way: str) -> None:
        if isinstance(inner, tuple):
            found.setdefault((inner[0], len(KINDS), inner[1]), "packed")
            return
        if not inner.text:
            return
        span = inner.source(0, len(inner.text))
        mark = (hashlib.sha256(inner.text.encode()).digest(), span)
        if mark in seen:
            return
        seen.add(mark)
        for start, kind, end in plain_secrets(inner.text):
            left, right = inner.source(start, end)
            found.setdefault((left, kind, right), way)
        work.append(inner)

    while work:
        layer = work.pop()
        if not isinstance(layer, Layer):
            if (inner := next(layer, None)) is not None:
                work.append(layer)
                search(inner, "base64")
            continue
        for inner in _unescaped(layer):
            if isinstance(inner, _Bytes):
                data = inner.text.encode("latin-1", "replace")
                if MAGIC.search(data):

                    def span_from(byte: int, inner=inner) -> tuple[int, int]:
                        return inner.source(byte, len(inner.text))

                    work.append(_packed(data, False, span_from, budget))
            else:
                search(inner, "escape")
        for inner in _from_base64(layer, budget):
            if isinstance(inner, Layer):
                search(inner, "base64")
            else:
                work.append(inner)
        for inner in _narrowed(layer):
            search(inner, "wide")
    names = (*KINDS, "opaque")
    return [(names[kind], start, end, found[start, kind, end]) for start, kind, end in sorted(found)]


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All secrets of each text, with spans in the text as it stands.

    Texts are taken whole, one by one in the task that reads them. A null or empty text
    has no spans; repeated rows are searched each; an empty table gives an empty result.
    Other columns are ignored. Result, a row for each input row: id, spans.
    """
    return find_spans(docs, find_secrets, id_col, text_col)


def secrets_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and hash of the plain matches, and all spans as a string."""
    return digest(found, id_col, KINDS)
