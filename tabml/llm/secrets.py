"""Secret scans by a recursive decoding worklist.

Each document's text is the first layer. A layer is scanned for every kind of
secret, then unwrapped in every way that applies: percent escapes, Unicode and
HTML character escapes, base64 (both alphabets, runs joined over line breaks, at
every alignment), UTF-16, and compressed data (gzip, zlib, bz2, xz, zstandard) anywhere
inside of what was decoded. What was decoded is searched as bytes, so it needn't be text. What comes out is a new layer. The worklist
runs until nothing new appears; layers that were seen before, at the same place of the
document, don't go on it again, so cycles end. Every layer knows, byte by
byte, which span of the document it comes from, and a secret found in it is
reported as that span.
"""

from __future__ import annotations

import bz2
import lzma
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabml.llm.common import arrow, only
from tabml.llm.pretokens import slices

#: the kinds, in the order in which spans with one start are listed
KINDS = ("assign", "access", "hex")

_ASSIGN_RULE = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_RULES = (_ASSIGN_RULE, r"AKIA[A-Z0-9]{16,}", r"[0-9a-f]{24,}")
#: of the document's text, and of what was decoded
_TEXT_RULES = tuple(re.compile(r, re.ASCII) for r in _RULES)
_BYTE_RULES = tuple(re.compile(r.encode()) for r in _RULES)

_PERCENT = re.compile(rb"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(rb"\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\u\{([0-9A-Fa-f]{1,6})\}|\\x([0-9A-Fa-f]{2})|&#[xX]([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
#: base64 characters (both alphabets) that a run has at least, line breaks not counted
_RUN = 16
#: bytes that a stretch of UTF-16 has at least, zeros not counted
_WIDE = 8
_SIX = np.full(256, 255, np.uint8)
for _i, _c in enumerate(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"):
    _SIX[_c] = _i
_SIX[ord("-")], _SIX[ord("_")] = 62, 63
#: bytes that percent encoding may leave as they are
_UNRESERVED = (_SIX < 64) | np.isin(np.arange(256), list(b".~"))
#: stands between stretches that don't adjoin; no pattern has it
_GAP = 0xFF
#: bytes that decompression gives at once
_OUT = 1 << 16
#: places in a text or layer (Spark's strings end at 2 GiB)
_PLACE = np.int32
#: base64 characters that are decoded at once
_BLOCK = 1 << 20
_BROKEN = zlib.error, OSError, ValueError, EOFError, lzma.LZMAError, zstandard.ZstdError
#: decompressed data over this is searched piece by piece, by steps of _STEP bytes
_WHOLE = 4 << 20
_STEP = 1 << 18
#: what may be the beginning of an escape
_OPEN_ESCAPE = re.compile(rb"(?:%[0-9A-Fa-f]?|\\(?:[uUx]\{?[0-9A-Fa-f]{0,8})?|&(?:#[xX]?[0-9A-Fa-f]{0,7})?)\Z")
#: a keyword whose value may follow
_OPEN_ASSIGN = re.compile(rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20?(?:[:=]\x20?["']?)?\Z""")
_ANY_ESCAPE = re.compile(_PERCENT.pattern + b"|" + _ESCAPE.pattern)
#: where compressed data may begin (gzip, zlib, bz2, xz, zstandard)
_MAGIC = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9](?:1AY&SY|\x17rE8P\x90)|\xfd7zXZ\x00|\x28\xb5\x2f\xfd")

#: what a slice's texts are screened for (RE2) before any of them is searched
_SCREENS = {
    "assign": r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]",
    "access": "AKIA[A-Z0-9]{16}",
    "hex": "[0-9a-f]{24}",
    "layers": r"%[0-9A-Fa-f]{2}|\\[uUx]|&#|(?:[A-Za-z0-9+/_-][\r\n]*){16}",
}

_SCHEMA = ("doc_id long, base array<struct<start: long, kind: int, end: long>>, "
           "decoded array<struct<start: long, kind: int, end: long, depth: int>>, n_layers int, n_oversize int")


def find(text: str | bytes, kinds=(0, 1, 2)) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the leftmost non-overlapping matches of each kind,
    failing ones dropped after they were matched."""
    assign, access, hexes = _TEXT_RULES if isinstance(text, str) else _BYTE_RULES
    out = []
    if 0 in kinds:
        out += [(m.start(), 0, m.end()) for m in assign.finditer(text) if m.end(2) - m.start(2) >= 6]
    # for these two, a match of fewer characters holds no other match
    if 1 in kinds:
        out += [(m.start(), 1, m.end()) for m in access.finditer(text)]
    if 2 in kinds:
        out += [(m.start(), 2, m.end()) for m in hexes.finditer(text)]
    return out


@dataclass
class Layer:
    """Byte k of ``data`` comes from the document's characters ``start[k]`` to
    ``end[k]`` (or all from one span). The document itself is a layer of one byte
    per character; those over U+00FF, which no rule and no encoding has, are ``?``.
    ``cuts`` are the places behind which encoded data isn't the same run any more."""
    data: bytes
    start: np.ndarray | int
    end: np.ndarray | int
    depth: int
    cuts: np.ndarray | None = None

    def span(self, a: int, b: int) -> tuple[int, int]:
        if isinstance(self.start, int):
            return self.start, self.end
        return int(self.start[a]), int(self.end[b - 1])

    def bounds(self) -> tuple[np.ndarray, np.ndarray]:
        if isinstance(self.start, int):
            n = len(self.data)
            return np.full(n, self.start, _PLACE), np.full(n, self.end, _PLACE)
        return self.start, self.end


def _reader(data: bytes):
    """A decompressor for what begins like compressed data, or None."""
    if data[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if data[:1] == b"\x78" and len(data) > 2 and (data[0] << 8 | data[1]) % 31 == 0:
        return zlib.decompressobj()
    if data[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if data[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor()
    if data[:4] == b"\x28\xb5\x2f\xfd":
        return zstandard.ZstdDecompressor().decompressobj()
    return None


def _pieces(reader, data: bytes) -> Iterator[bytes]:
    """What a decompressor makes of input, at most _OUT bytes at once (zstandard:
    of one block after the other)."""
    if hasattr(reader, "needs_input"):
        yield reader.decompress(data, _OUT)
        while not reader.needs_input and not reader.eof:
            yield reader.decompress(b"", _OUT)
    elif hasattr(reader, "copy"):
        yield reader.decompress(data, _OUT)
        while reader.unconsumed_tail and not reader.eof:
            yield reader.decompress(reader.unconsumed_tail, _OUT)
    else:
        yield reader.decompress(data)


class Members:
    """Decompresses members that follow each other (zero bytes between them are
    padding), fed piece by piece. ``bounds`` are where they begin in the input and,
    once reached, end."""

    def __init__(self) -> None:
        self.reader, self.head, self.at, self.done, self.bounds = None, b"", 0, False, []

    @property
    def end(self) -> int:
        """Where the last whole member ends, 0 without any."""
        return max((b for _, b in self.bounds if b), default=0)

    def feed(self, data: bytes | memoryview, final: bool) -> Iterator[bytes]:
        data, at = (self.head + bytes(data) if self.head else data), 0
        self.head, first = b"", self.at
        while not self.done:
            if self.reader is None:
                while self.bounds and at < len(data) and not data[at]:
                    at += 1
                if len(data) - at < 10 and not final:
                    self.head, self.at = bytes(data[at:]), first + at
                    return
                self.reader = _reader(bytes(data[at:at + 10]))
                if self.reader is None:
                    self.done = True
                    return
                self.bounds.append((first + at, 0))
            piece = bytes(data[at:at + 256])
            if not piece:
                break
            spare = self.reader.copy() if hasattr(self.reader, "copy") else None
            size = 0
            try:
                for out in _pieces(self.reader, piece):
                    size += len(out)
                    yield out
            except _BROKEN:
                yield from self._broken(spare, piece, size)
                return
            at += len(piece)
            if self.reader.eof:
                at -= len(self.reader.unused_data)
                self.bounds[-1] = self.bounds[-1][0], first + at
                self.reader = None
        self.at = first + at
        if final and self.reader is not None and hasattr(self.reader, "flush") and hasattr(self.reader, "copy"):
            try:
                yield self.reader.flush()
            except _BROKEN:
                pass

    def _broken(self, spare, piece: bytes, known: int) -> Iterator[bytes]:
        """What the piece held before its broken place."""
        self.done = True
        try:
            for k in range(len(piece) if spare is not None else 0):
                for out in _pieces(spare, piece[k:k + 1]):
                    yield out[known:]
                    known = max(0, known - len(out))
        except _BROKEN:
            pass


def _replaced(layer: Layer, pattern: re.Pattern, decode, run: np.ndarray | None) -> Layer | None:
    """The layer with every match decoded; ``decode`` gives the bytes and how many
    bytes of the match each stands for (None: the whole match), or None to leave it; ``run`` says which
    bytes stand for themselves in encoded data."""
    parts, starts, ends, at, any_ = [], [], [], 0, False
    low, high = layer.bounds()
    for m in pattern.finditer(layer.data):
        found = decode(m)
        if found is None:
            continue
        any_ = True
        a, b = m.span()
        data, step = found[0], found[1] or b - a
        parts += [layer.data[at:a], data]
        starts += [low[at:a], low[a:b:step]]
        ends += [high[at:a], high[a + step - 1:b:step]]
        at = b
    if not any_:
        return None
    parts.append(layer.data[at:])
    starts.append(low[at:])
    ends.append(high[at:])
    data, cuts = b"".join(parts), None
    if run is not None:
        # parts are copied and decoded in turns
        sizes = np.array([len(x) for x in parts])
        copied = np.repeat(np.arange(len(parts)) % 2 == 0, sizes)
        cuts = np.flatnonzero(copied & ~run[np.frombuffer(data, np.uint8)]).astype(_PLACE)
    return Layer(data, np.concatenate(starts), np.concatenate(ends), layer.depth + 1, cuts)


def _percent(m: re.Match):
    return bytes.fromhex(m.group().replace(b"%", b"").decode()), 3


def _escape(m: re.Match):
    code = next(int(g, 10 if i == 5 else 16) for i, g in enumerate(m.groups()) if g)
    if code > 0x10FFFF or 0xD800 <= code < 0xE000:
        return None
    return bytes([code]) if code < 256 else b"?", None


def _groups(chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of bytes: the places of the base64 characters that stand in runs of _RUN or
    more (line breaks inside of a run left out), each one's place in its run, and
    whether the next one belongs to the same run."""
    breaks = (chars == 10) | (chars == 13)
    kept = np.flatnonzero(~breaks).astype(_PLACE) if breaks.any() else None
    inside = _SIX[chars if kept is None else chars[kept]] < 64
    edge = np.flatnonzero(np.diff(np.r_[False, inside, False].astype(np.int8)))
    first, size = edge[::2], edge[1::2] - edge[::2]
    first, size = first[size >= _RUN].astype(_PLACE), size[size >= _RUN]
    ends = np.cumsum(size)
    within = np.arange(int(size.sum()), dtype=_PLACE)
    within -= np.repeat((ends - size).astype(_PLACE), size)
    place = within + np.repeat(first, size)
    more = np.ones(len(within), bool)
    more[ends - 1] = False
    return place if kept is None else kept[place], within, more


def _aligned(chars: np.ndarray, goes_on: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """What the runs of base64 hold, at each of the four alignments of the groups of
    four: the bytes, where in them a new run begins, and the places of the first
    and the last character of each byte. ``goes_on``: the first run is the rest of one."""
    place, within, more = _groups(chars)
    if not len(place):
        return
    six = _SIX[chars[place]]
    rest = 0
    if goes_on:
        begins = np.flatnonzero(within == 0)
        rest = int(begins[1]) if len(begins) > 1 else len(within)
    for shift in range(4):
        parts = []
        for at in range(0, len(place), _BLOCK):
            w = within[at:at + _BLOCK]
            # the k-th character of a group and its neighbour make the k-th byte
            k = (w - shift) & 3
            begun = w >= shift
            begun[:max(0, rest - at)] = True
            make = np.flatnonzero(more[at:at + _BLOCK] & (k != 3) & begun)
            pair = six[make + at].astype(np.uint16) << 6 | six[make + (at + 1)]
            byte = (pair >> (4 - 2 * k[make]).astype(np.uint16)).astype(np.uint8)
            parts.append((byte, w[make], place[make + at], place[make + (at + 1)]))
        byte, w, low, high = (np.concatenate(x) for x in zip(*parts))
        yield byte, np.flatnonzero(w[1:] < w[:-1]) + 1, low, high


def _base64(layer: Layer) -> Iterator[Layer]:
    """A layer for each alignment. Data that begins anywhere in a run (behind a path,
    a prefix or a word on the line before) is the end of one of them."""
    low, high = layer.bounds()
    for byte, ends, a, b in _aligned(np.frombuffer(layer.data, np.uint8)):
        yield Layer(np.insert(byte, ends, _GAP).tobytes(), np.insert(low[a], ends, low[a][ends]), np.insert(high[b], ends, high[b][ends]),
                    layer.depth + 1, ends + np.arange(len(ends)))


def _every_second(chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of bytes with a zero beside them, and where a new stretch of
    such bytes (zeros between them) begins."""
    zero = chars == 0
    beside = np.r_[zero[1:], True] | np.r_[True, zero[:-1]]
    place = np.flatnonzero(~zero & beside)
    new = np.r_[True, (np.diff(place) != 2) | ~zero[place[:-1] + 1]] if len(place) else np.zeros(0, bool)
    return place, new


def _wide(layer: Layer) -> Layer | None:
    """The stretches of UTF-16 (either byte order): every second byte is zero."""
    place, new = _every_second(np.frombuffer(layer.data, np.uint8))
    size = np.diff(np.append(np.flatnonzero(new), len(place)))
    place = place[np.repeat(size, size) >= _WIDE]
    size = size[size >= _WIDE]
    if not len(place):
        return None
    low, high = layer.bounds()
    ends = np.cumsum(size)[:-1]
    low, high, data = low[place], high[place], np.frombuffer(layer.data, np.uint8)[place]
    return Layer(np.insert(data, ends, _GAP).tobytes(), np.insert(low, ends, low[ends]), np.insert(high, ends, high[ends]), layer.depth + 1)


class Stream:
    """Searches a layer that comes piece by piece and is nowhere whole. All of it
    has one span, so it only matters which kinds it holds (``found``, by depth).

    Carried from step to step are: the beginning of a match, the characters of
    an open base64 run (its bytes go on to four streams), an open escape, two
    bytes for UTF-16, and the decompressors of open members.

    The stream of the same data with its escapes undone begins with the layer or not
    at all: where the first escape only shows after the first step, the stream's ``path``
    is noted in ``late``, and Work reads the data again with that stream from the start."""

    def __init__(self, work: Work, depth: int, late: set[tuple], path: tuple = ()) -> None:
        self.work, self.depth, self.found = work, depth, set()
        self.late, self.path, self.first = late, path, True
        self.buffer, self.size = [], 0
        self.tail, self.assign = b"", b""
        self.run, self.goes_on, self.aligned = b"", False, []
        self.held, self.plain = b"", None
        self.pair, self.wide, self.next_wide = b"\xff\xff", None, 0
        self.members, self.magic, self.at = [], b"", 0

    def feed(self, data: bytes) -> None:
        for a in range(0, len(data), _STEP):
            self.buffer.append(data[a:a + _STEP])
            self.size += len(self.buffer[-1])
            if self.size >= _STEP:
                self._step(False)

    def close(self) -> set[tuple[int, int]]:
        self._step(True)
        for inner in (*self.aligned, self.plain, self.wide):
            if inner is not None:
                self.found |= inner.close()
        return self.found

    def _step(self, final: bool) -> None:
        data = b"".join(self.buffer)
        self.buffer, self.size = [], 0
        self._find(data)
        self._runs(data, final)
        self._escapes(data, final)
        self._second(data, final)
        self._members(data, final)

    def _inner(self, step: tuple) -> Stream:
        return Stream(self.work, self.depth + 1, self.late, (*self.path, step))

    def _find(self, data: bytes) -> None:
        # how many blanks there are doesn't matter to the rule
        text, at, open_ = self.assign + data, 0, None
        if b"  " in text:
            text = re.sub(rb"\x20{2,}", b" ", text)
        for m in _BYTE_RULES[0].finditer(text) if b"=" in text or b":" in text else ():
            if m.end(2) - m.start(2) >= 6:
                self.found.add((0, self.depth))
            at = m.end()
            if at == len(text):
                # the value may go on: its first characters stand for it
                open_ = text[m.start():m.start(2) + 8]
        if open_ is None:
            m = _OPEN_ASSIGN.search(text, max(at, len(text) - 16))
            open_ = m.group() if m else text[max(at, len(text) - 8):]
        self.assign = open_
        text = self.tail + data
        self.found |= {(kind, self.depth) for _, kind, _ in find(text, (1, 2))}
        self.tail = text[-24:]

    def _runs(self, data: bytes, final: bool) -> None:
        data = self.run + data
        chars, goes_on = np.frombuffer(data, np.uint8), self.goes_on
        self.run, self.goes_on = b"", False
        if not final:
            other = np.flatnonzero((_SIX[chars] > 63) & (chars != 10) & (chars != 13))
            body = int(other[-1]) + 1 if len(other) else 0
            rest = data[body:].translate(None, b"\r\n")
            if len(rest) < 4 * _RUN:
                # short enough to wait whole, also as the rest of a run
                self.run, self.goes_on, data = rest, goes_on and not body, data[:body]
            else:
                # by groups of four; a byte needs the next character too
                cut = (len(rest) - _RUN) // 4 * 4
                self.run, self.goes_on, data = rest[cut:], True, data[:body] + rest[:cut + 1]
            chars = np.frombuffer(data, np.uint8)
        for k, (byte, ends, *_) in enumerate(_aligned(chars, goes_on)):
            if len(self.aligned) <= k:
                self.aligned.append(self._inner(("base64", k)))
            self.aligned[k].feed(np.insert(byte, ends, _GAP).tobytes())
        if not self.goes_on and len(data):
            for inner in self.aligned:
                inner.feed(bytes([_GAP]))

    def _escapes(self, data: bytes, final: bool) -> None:
        data = self.held + data
        self.held = b""
        if not final and (m := _OPEN_ESCAPE.search(data, max(0, len(data) - 16))):
            self.held, data = data[m.start():], data[:m.start()]
        text = data
        if b"%" in data or b"\\" in data or b"&#" in data:
            text = _ANY_ESCAPE.sub(lambda m: ((_percent if m.group()[:1] == b"%" else _escape)(m) or (m.group(),))[0], data)
        if self.first and (text != data or self.path in self.late):
            self.plain = self._inner(("escapes", 0))
        self.first = False
        if self.plain is not None:
            self.plain.feed(text)
        elif text != data:
            self.late.add(self.path)

    def _second(self, data: bytes, final: bool) -> None:
        data = self.pair + data + (b"\xff" if final else b"")
        self.pair = data[-2:]
        place, _ = _every_second(chars := np.frombuffer(data, np.uint8))
        # the neighbours of the first and the last byte aren't here
        place = place[(place > 0) & (place < len(data) - 1)]
        if len(place):
            new = (np.diff(place, prepend=self.next_wide - 2) != 2) | (chars[place - 1] != 0)
            if self.wide is None:
                self.wide = self._inner(("wide", 0))
            self.wide.feed(np.insert(chars[place], np.flatnonzero(new), _GAP).tobytes())
        self.next_wide = (int(place[-1]) + 2 if len(place) else 0) - (len(data) - 2)

    def _members(self, data: bytes, final: bool) -> None:
        text, first = self.magic + data, self.at - len(self.magic)
        for m in self.members:
            m.feed(data, final)
        begun = {m.first + a for m in self.members for a, _ in m.chain.bounds}
        keep = 0 if final else 9
        for m in _MAGIC.finditer(text):
            at = first + m.start()
            if m.start() < len(text) - keep and at not in begun:
                self.members.append(Member(self, at))
                self.members[-1].feed(text[m.start():], final)
                begun |= {at + a for a, _ in self.members[-1].chain.bounds}
        self.members = [m for m in self.members if not m.closed]
        self.magic, self.at = text[max(0, len(text) - keep):] if keep else b"", self.at + len(data)


class Member:
    """Compressed data in a stream: searched whole while it is small, else as a stream."""

    def __init__(self, outer: Stream, first: int) -> None:
        self.outer, self.first, self.chain = outer, first, Members()
        self.sink, self.closed = Sink(outer.work, outer.depth + 1, outer.late, (*outer.path, ("member", first))), False

    def feed(self, data: bytes, final: bool) -> None:
        for out in self.chain.feed(data, final):
            self.sink.feed(out)
        if self.chain.done or final:
            self.closed = True
            found = self.sink.close()
            if found is None:
                layer = Layer(b"".join(self.sink.parts), 0, 0, self.outer.depth + 1)
                found = {(kind, depth) for _, kind, _, depth in self.outer.work.run([layer])} if layer.data else set()
            self.outer.found |= found


class Sink:
    """Takes decompressed data: kept in ``parts`` up to _WHOLE bytes, from there on in a stream."""

    def __init__(self, work: Work, depth: int, late: set[tuple], path: tuple = ()) -> None:
        self.work, self.depth, self.parts, self.size, self.stream = work, depth, [], 0, None
        self.late, self.path = late, path

    def feed(self, out: bytes) -> None:
        was, self.size = self.size, self.size + len(out)
        self.work.oversize += was <= self.work.limit < self.size
        if self.stream is None:
            self.parts.append(out)
            if self.size > min(_WHOLE, self.work.limit):
                self.stream = Stream(self.work, self.depth, self.late, self.path)
                for x in self.parts:
                    self.stream.feed(x)
                self.parts = []
        else:
            self.stream.feed(out)

    def close(self) -> set[tuple[int, int]] | None:
        """The kinds found (by depth) of what went to a stream."""
        return None if self.stream is None else self.stream.close()


class Work:
    """The worklist of one document; ``limit`` only decides what counts as oversize."""

    def __init__(self, limit: int) -> None:
        self.limit, self.layers, self.oversize, self.streams = limit, 0, 0, set()

    def _inflated(self, layer: Layer) -> Iterator[Layer | tuple[int, int, int, int]]:
        """What compressed data holds, wherever it begins: layers, and the spans found in those too large to be whole."""
        at, data = 0, memoryview(layer.data)
        cuts = np.zeros(0, int) if layer.cuts is None else layer.cuts
        while (m := _MAGIC.search(layer.data, at)) is not None:
            start, at = m.start(), m.start() + 1
            # to the end of its run; behind it only if that makes it whole
            stops, tries = [*cuts[(k := np.searchsorted(cuts, start)):k + 1].tolist(), len(data)], []
            oversize, layers = self.oversize, self.layers
            for stop in stops:
                late, known = set(), -1
                # again while escapes turn up in streams that weren't undone from their start:
                # as often as late escapes are nested
                while known < len(late):
                    self.oversize, self.layers, known = oversize, layers, len(late)
                    chain, sink, sizes = Members(), Sink(self, layer.depth + 1, late), []
                    for out in chain.feed(data[start:stop], True):
                        sizes += [0] * (len(chain.bounds) - len(sizes))
                        sizes[-1] += len(out)
                        sink.feed(out)
                    found = sink.close()
                tries.append((stop, chain, sink, sizes, found))
                if chain.end:
                    break
            stop, chain, sink, sizes, found = tries[-1] if tries[-1][1].end else tries[0]
            at = max(at, start + chain.end)
            spans = [layer.span(start + a, start + b if b else stop) for a, b in chain.bounds]
            if found is not None:
                low, high = spans[0][0], spans[-1][1]
                self.streams |= {(low, high)} if chain.bounds[-1][1] else set()
                yield from ((low, kind, high, depth) for kind, depth in sorted(found))
            elif sink.size:
                self.streams.update(x for x, (_, b) in zip(spans, chain.bounds) if b)
                spans = spans[:len(sizes)]
                low, high = zip(*spans)
                one = len(set(spans)) == 1
                yield Layer(b"".join(sink.parts), low[0] if one else np.repeat(low, sizes), high[0] if one else np.repeat(high, sizes), layer.depth + 1)

    def unwrap(self, layer: Layer) -> Iterator[Layer | tuple[int, int, int, int]]:
        """The layers inside a layer (or the spans found there) but those of base64."""
        for pattern, decode, run in ((_PERCENT, _percent, _UNRESERVED), (_ESCAPE, _escape, None)):
            if (inner := _replaced(layer, pattern, decode, run)) is not None:
                yield inner
        if layer.depth:
            if (inner := _wide(layer)) is not None:
                yield inner
            yield from self._inflated(layer)

    def run(self, todo: list[Layer]) -> Iterator[tuple[int, int, int, int]]:
        """The spans (start, kind, end, depth) in the layers and all that is inside of them; not those of a document itself."""
        seen = set()

        def new(layer):
            mark = blake2b(layer.data, digest_size=16).digest(), *layer.span(0, len(layer.data))
            return not (mark in seen or seen.add(mark))

        def spans(layer):
            for a, kind, b in find(layer.data):
                start, end = layer.span(a, b)
                yield start, kind, end, layer.depth

        for layer in todo:
            if layer.depth and new(layer):
                yield from spans(layer)
        while todo:
            item = todo.pop()
            if isinstance(item, Layer):
                # of the alignments one is held at a time: their iterator waits on the worklist
                inside, waiting = self.unwrap(item), _base64(item)
            else:
                inside, waiting = islice(item, 1), item
            fresh, got = [], False
            for inner in inside:
                got = True
                if isinstance(inner, tuple):
                    yield inner
                elif inner.data and new(inner):
                    fresh.append(inner)
                    yield from spans(inner)
            # a layer's alignments come before its other layers, so that it isn't held for long
            if isinstance(item, Layer):
                todo += [*fresh, waiting]
            elif got:
                todo += [waiting, *fresh]
        self.layers += len(seen)


def scan(text: str, limit: int, kinds=(0, 1, 2), layers: bool = True):
    """(base spans, spans that decoding adds with their depth, layers, oversize
    layers) of a whole text; spans as (start, kind, end), sorted."""
    base = sorted(find(text, kinds))
    if not layers:
        return base, [], 0, 0
    known, depths, work = set(base), {}, Work(limit)
    positions = np.arange(len(text) + 1, dtype=_PLACE)
    for span in work.run([Layer(text.encode("latin-1", "replace"), positions[:-1], positions[1:], 0)]):
        if span[:3] not in known:
            depths[span[:3]] = min(span[3], depths.get(span[:3], span[3]))
    added = [(*span, depth) for span, depth in depths.items()]
    # data that is stored rather than compressed also shows as it is: once is enough
    whole = {(a, kind, b) for a, kind, b, _ in added if (a, b) in work.streams}
    added = [x for x in added if not any(a <= x[0] and x[2] <= b and kind == x[1] and (a, b) != (x[0], x[2]) for a, kind, b in whole)]
    return base, sorted(added), work.layers, work.oversize


def secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_layer_bytes: int = 64 << 20) -> DataFrame:
    """One row per input row: doc_id, base and decoded (arrays of spans: start, kind as a
    place in KINDS, end; code points, end exclusive), n_layers, n_oversize.

    ``base`` are the spans in the text as it stands, ``decoded`` those that only
    show in a decoded layer, with its depth. Whole texts; null counts as empty
    and has none. Decompressed data of any size is searched, over _WHOLE bytes piece by
    piece; ``n_oversize`` counts what is over ``max_layer_bytes``. Repeated rows get
    equal results. An empty table gives no rows. Other columns are ignored.
    """
    schema = arrow(_SCHEMA)
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, at = b.column("doc_id"), 0
            for texts in slices(b.column("text")):
                hits = {k: pc.match_substring_regex(texts, p).to_numpy(zero_copy_only=False) for k, p in _SCREENS.items()}
                some = np.flatnonzero(np.logical_or.reduce(list(hits.values())))
                found = {}
                for i in some.tolist():
                    kinds = [k for k, name in enumerate(KINDS) if hits[name][i]]
                    found[i] = scan(texts[i].as_py(), max_layer_bytes, kinds, bool(hits["layers"][i]))
                none = ([], [], 0, 0)
                rows = [found.get(i, none) for i in range(len(texts))]
                base = [[dict(zip(("start", "kind", "end"), s)) for s in r[0]] for r in rows]
                decoded = [[dict(zip(("start", "kind", "end", "depth"), s)) for s in r[1]] for r in rows]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, len(texts)), pa.array(base, schema.field("base").type), pa.array(decoded, schema.field("decoded").type),
                     pa.array([r[2] for r in rows], pa.int32()), pa.array([r[3] for r in rows], pa.int32())], names)
                at += len(texts)

    docs = only(df, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return docs.mapInArrow(run, _SCHEMA)


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, by start, then kind as listed, then end."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")
