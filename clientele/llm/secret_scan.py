"""Secret scan with a recursive decoding worklist.

The base scan finds three kinds of secrets in a text (patterns below). The worklist then
unwraps encoded layers: percent escapes, Unicode and character escapes, base64 (plain or
URL-safe, padded or not, on one line or wrapped) and compressed data (gzip, zlib, bzip2, xz). Every unwrapped
layer is scanned with the same patterns and searched for further layers, until none is
left. Escapes are replaced over the whole text, and what touches one is kept. Findings in a layer are mapped back to the code points of the original text: a
character that came through escapes maps to its own escape, one that came out of base64 or
compressed data maps to the whole encoded run. Content that already came out of the same
place is not unwrapped again (cycle detection). Nothing is recursive: the worklist is an explicit
stack, maps lead straight to the original text, and escapes nested more than ``STEPWISE`` deep are
resolved to the end in one pass over the text, so a text takes linear time for any depth.

A compressed member may unpack to at most ``MAX_LAYER_BYTES`` (protection against
decompression bombs); a larger one stays closed, with what follows it in the same layer, and
is counted in ``closed_layers``. Members and streams in a row are read to the end.

Scale. Rows are scanned where they are read: no shuffle, memory of a few batches plus one
text's layers. Vectorised byte tests pick the texts and runs that can hold a finding.

Defined results. Null text: empty, no finding. Very long texts: scanned whole. Repeated
rows: one result each. Empty table: empty result. Extra columns: ignored. Overlapping
findings of different kinds or layers are all reported; equal (kind, start, end) once.
"""

from __future__ import annotations

import binascii
import bz2
import hashlib
import html
import lzma
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.words import utf8
from clientele.llm.workers import tidy

MAX_LAYER_BYTES = 64 << 20
FEED, OVERLAP = 1 << 16, 1 << 16
# Kinds in their order, patterns and shortest lengths.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a maximal run of 24 or more
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24
# "token=" and six characters are the shortest secret; base64 makes 16 characters of them.
MIN_BASE64 = 16

PERCENT_RUN = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"\\u\{[0-9A-Fa-f]{1,6}\}|(?:\\u[0-9A-Fa-f]{4})+|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}"
                    r"|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};")
# the same at the end of a text, one escape
LAST_ESCAPE = re.compile(r"(?:%[0-9A-Fa-f]{2}|\\u\{[0-9A-Fa-f]{1,6}\}|\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}"
                         r"|\\x[0-9A-Fa-f]{2}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};)\Z")
ESCAPE_ENDS = frozenset("0123456789abcdefABCDEF};")
LONGEST_ESCAPE = 10
STEPWISE = 8  # escapes nested deeper are resolved in one pass
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
# base64 on consecutive lines, indented or not
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:[ \t]*+(?:\r\n?|\n)[ \t]*+[A-Za-z0-9+/_-]++)++={0,2}")
WRAPPED_BYTES = re.compile(WRAPPED.pattern.encode())
LINE = re.compile(rb"[A-Za-z0-9+/_-]+")
BASE64_PART = re.compile(r"[A-Za-z0-9+]{16,}")
# a secret's word, a base pattern, an escape, or base64 (also over a line end)
PROMISING = re.compile(rb"(?i:password|passwd|secret|token|api_?key)|AKIA|[0-9a-f]{24}|%[0-9A-Fa-f]{2}|\\[uUx]|&#"
                       rb"|[A-Za-z0-9+/_-]{16}|[A-Za-z0-9+/_-][ \t]*[\r\n]+[ \t]*[A-Za-z0-9+/_-]")


def scan(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base patterns; end exclusive."""
    found = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [(0, *m.span()) for m in ASSIGN.finditer(text)
                  if m.end(2) - m.start(2) >= MIN_VALUE]
    if "AKIA" in text:
        found += [(1, *m.span()) for m in ACCESS.finditer(text)
                  if m.end() - m.start() >= MIN_ACCESS]
    found += [(2, *m.span()) for m in HEX.finditer(text)]
    return found


@dataclass
class Edits:
    """Pieces of a text with replaced escapes: piece i begins at ``at[i]`` and came from
    ``lo[i]`` to ``hi[i]`` of the original text; a ``whole`` one comes from escapes, whose
    characters all map to all of it. ``new`` tells those of the last step."""

    at: list[int] = field(default_factory=list)
    lo: list[int] = field(default_factory=list)
    hi: list[int] = field(default_factory=list)
    whole: list[bool] = field(default_factory=list)
    new: list[bool] = field(default_factory=list)

    def add(self, *piece) -> None:
        for column, value in zip((self.at, self.lo, self.hi, self.whole, self.new), piece):
            column.append(value)

    def pieces(self, lo: int, hi: int) -> tuple[int, int]:
        return bisect_right(self.at, lo) - 1, bisect_right(self.at, max(lo, hi - 1)) - 1

    def origin(self, lo: int, hi: int) -> tuple[int, int]:
        i, j = self.pieces(lo, hi)
        return (self.lo[i] if self.whole[i] else self.lo[i] + lo - self.at[i],
                self.hi[j] if self.whole[j] else self.lo[j] + hi - self.at[j])

    def kept(self, at: int, lo: int, hi: int, into: Edits) -> None:
        """Add what stands here from lo to hi, unchanged, to ``into`` at ``at``."""
        i, j = self.pieces(lo, hi)
        for k in range(i, j + 1):
            first = max(lo, self.at[k])
            last = hi if k == j else self.at[k + 1]
            into.add(at + first - lo, *self.origin(first, last), self.whole[k], False)


@dataclass
class Layer:
    """Unwrapped content. With ``edits`` it is a text with escapes replaced, ``steps`` times so
    far; otherwise every character came from ``whole``. ``around``: keys of layers that it is known
    to lie in."""

    content: str | bytes
    whole: tuple[int, int]
    route: tuple[str, ...]
    edits: Edits | None = None
    around: frozenset = field(default_factory=frozenset)
    steps: int = 0

    def origin(self, lo: int, hi: int) -> tuple[int, int]:
        return self.whole if self.edits is None else self.edits.origin(lo, hi)

    def is_new(self, lo: int, hi: int) -> bool:
        """Did anything from lo to hi come out of an escape in the last step? The rest was
        there before."""
        if self.edits is None:
            return True
        i, j = self.edits.pieces(lo, hi)
        return any(self.edits.new[i:j + 1])

    def key(self) -> tuple[bool, bytes, tuple[int, int]]:
        is_text = isinstance(self.content, str)
        data = self.content.encode("utf-8", "replace") if is_text else self.content
        return is_text, hashlib.sha256(data).digest(), self.whole


def _kept(parent: Layer | None, at: int, lo: int, hi: int, into: Edits) -> None:
    if parent is None:
        into.add(at, lo, hi, False, False)
    elif parent.edits is None:
        into.add(at, *parent.whole, True, False)
    else:
        parent.edits.kept(at, lo, hi, into)


def _origin(parent: Layer | None, lo: int, hi: int) -> tuple[int, int]:
    return (lo, hi) if parent is None else parent.origin(lo, hi)


def _substituted(parent: Layer | None, text: str, runs: re.Pattern, decode, name: str) -> Layer | None:
    """The whole text with its escapes replaced: what is encoded in part (a key without its
    value, a quote) stands together again. Every character knows its origin."""
    out, edits, at, n = [], Edits(), 0, 0
    for m in runs.finditer(text):
        decoded = decode(m.group())
        if decoded == m.group():
            continue
        if m.start() > at:
            _kept(parent, n, at, m.start(), edits)
            out.append(text[at:m.start()])
            n += m.start() - at
        if decoded:
            edits.add(n, *_origin(parent, *m.span()), True, True)
            out.append(decoded)
            n += len(decoded)
        at = m.end()
    if not at:
        return None
    if at < len(text):
        _kept(parent, n, at, len(text), edits)
        out.append(text[at:])
    return _as_layer(parent, text, "".join(out), edits, name)


def _as_layer(parent: Layer | None, text: str, content: str, edits: Edits, name: str) -> Layer:
    route, steps = ((), 0) if parent is None else (parent.route, parent.steps)
    return Layer(content, _origin(parent, 0, len(text)), (*route, name), edits, steps=steps + 1)


def _resolved(parent: Layer, text: str) -> Layer | None:
    """The text with its escapes replaced until none is left, in one pass: whenever what was
    read so far ends with an escape, that is replaced at once, so that an escape within an
    escape, to any depth, costs one step."""
    out: list[str] = []
    lo: list[int] = []
    hi: list[int] = []
    replaced: list[bool] = []
    changed = False
    for i, c in enumerate(text):
        out.append(c)
        lo.append(i)
        hi.append(i + 1)
        replaced.append(False)
        while out and out[-1] in ESCAPE_ENDS:
            m = LAST_ESCAPE.search("".join(out[-LONGEST_ESCAPE:]))
            if m is None:
                break
            size, run = len(m.group()), m.group()
            decoded = chr(int(run[1:], 16)) if run[0] == "%" else _escape(run)
            if len(decoded) != 1:
                break
            first = lo[-size]
            for column in (out, lo, hi, replaced):
                del column[-size:]
            out.append(decoded)
            lo.append(first)
            hi.append(i + 1)
            replaced.append(True)
            changed = True
    if not changed:
        return None
    edits, n = Edits(), len(out)
    at = 0
    while at < n:
        end = at + 1
        if replaced[at]:
            edits.add(at, *_origin(parent, lo[at], hi[at]), True, True)
        else:
            while end < n and not replaced[end]:
                end += 1
            _kept(parent, at, lo[at], hi[end - 1], edits)
        at = end
    return _as_layer(parent, text, "".join(out), edits, "nested")


def _percent(run: str) -> str:
    return bytes.fromhex(run.replace("%", "")).decode("utf-8", "replace")


def _escape(run: str) -> str:
    if run.startswith("&"):
        return html.unescape(run)
    if run.startswith("\\u{"):
        code = int(run[3:-1], 16)
        return chr(code) if code < 0x110000 else run
    if run[1] in "xU":
        code = int(run[2:], 16)
        return chr(code) if code < 0x110000 else run
    units = b"".join(int(x, 16).to_bytes(2, "big") for x in run.split("\\u")[1:])
    return units.decode("utf-16-be", "replace")


def _from_base64(run: bytes) -> bytes | None:
    body = run.rstrip(b"=").translate(bytes.maketrans(b"-_", b"+/"))
    if len(body) % 4 == 1:
        return None
    try:
        return binascii.a2b_base64(body + b"=" * (-len(body) % 4))
    except binascii.Error:
        return None


def _format(data: bytes) -> tuple[str, Callable] | None:
    """Name and decompressor of the format that the first bytes tell."""
    if data[:2] == b"\x1f\x8b":
        return "gzip", lambda: zlib.decompressobj(31)
    if data[:1] == b"\x78" and len(data) > 2 and int.from_bytes(data[:2], "big") % 31 == 0:
        return "zlib", zlib.decompressobj
    if data[:3] == b"BZh":
        return "bzip2", bz2.BZ2Decompressor
    if data[:6] == b"\xfd7zXZ\x00":
        return "xz", lzma.LZMADecompressor
    return None


def _member(unpacker, data: bytes, at: int) -> tuple[bytes | None, int | None]:
    """(content, end) of one compressed member; content None beyond the bound, end None
    where the data break off or are damaged."""
    parts, size = [], 0
    try:
        while at < len(data) and not unpacker.eof:
            fed = data[at:at + FEED]
            at += len(fed)
            part = unpacker.decompress(fed, MAX_LAYER_BYTES + 1 - size)
            parts.append(part)
            size += len(part)
            if size > MAX_LAYER_BYTES:
                return None, None
    except (zlib.error, OSError, lzma.LZMAError, EOFError):
        return b"".join(parts), None
    return b"".join(parts), at - len(unpacker.unused_data) if unpacker.eof else None


def _unpacked(data: bytes) -> Iterator[tuple[str, bytes | None]]:
    """(format, content) of compressed data, all members and streams in a row as one content;
    content None for a member that exceeds the bound. Contents that exceed it only together
    come one after the other, each with the end of the one before. What follows the last
    member, or is damaged, comes as it is, without format."""
    at, name, kept, size = 0, "", [], 0
    while at < len(data):
        found = _format(data[at:at + 6])
        if not found:
            break
        content, end = _member(found[1](), data, at)
        if content is None:
            if kept:
                yield name, b"".join(kept)
            yield found[0], None
            return
        if kept and (size + len(content) > MAX_LAYER_BYTES or found[0] != name):
            whole = b"".join(kept)
            yield name, whole
            kept = [whole[-OVERLAP:]]
            size = len(kept[0])
        if content:
            name = found[0]
            kept.append(content)
            size += len(content)
        if end is None:
            break
        at = end
        while data[at:at + 4] == bytes(4):  # padding between streams
            at += 4
    if kept:
        yield name, b"".join(kept)
    if at < len(data):
        yield "", data[at:]


def _texts(data: bytes) -> list[str]:
    """Readings of decoded bytes: as UTF-8, where anything else is replaced (the patterns are
    ASCII), and as UTF-16, without which there is no NUL in a text."""
    out = [data.decode("utf-8", "replace")]
    if b"\x00" in data:
        even = data[:len(data) & ~1]
        out += [even.decode(code, "replace") for code in ("utf-16-le", "utf-16-be")]
    return out


def _promising(data: bytes) -> bool:
    """Can the bytes, in any reading, hold a finding or a further layer?"""
    return bool(_format(data) or PROMISING.search(data)
                or (b"\x00" in data and PROMISING.search(data.replace(b"\x00", b""))))


def _joined(run: bytes) -> Iterator[tuple[bytes, int]]:
    """(characters, first byte) of wrapped base64. What stands before it (a word at a line end)
    may be no base64: decoding starts at the first line of each alignment, and where compressed
    data start."""
    seen, n = set(), 0
    lines = list(LINE.finditer(run))
    whole = b"".join(m.group() for m in lines)
    for m in lines:
        head = _from_base64(whole[n:n + 16])
        if n % 4 not in seen or (head and _format(head)):
            seen.add(n % 4)
            body = whole[n:]
            yield (body[:-1] if len(body) % 4 == 1 else body), m.start()
        n += len(m.group())


def base64_layers(run: bytes, origin: Callable[[int, int], tuple[int, int]],
                  route: tuple[str, ...]) -> list[Layer]:
    """The run decoded, and its parts between characters that are also separators (paths,
    slugs), or its lines joined; without what can hold neither a finding nor a further layer."""
    if b"\n" in run or b"\r" in run:
        runs = list(_joined(run.rstrip(b"=")))
    else:
        runs = [(run, 0)]
        if any(c in run for c in b"/_-"):
            runs += [(m.group().encode(), 0) for m in BASE64_PART.finditer(run.decode())]
    out = []
    for r, at in runs:
        data = _from_base64(r)
        if data and _promising(data):
            out.append(Layer(data, origin(at, len(run)), (*route, "base64")))
    return out


def _inside(parent: Layer | None, start: int) -> Callable[[int, int], tuple[int, int]]:
    """Origins of what begins at ``start`` of the parent's text, or of the original."""
    def origin(lo: int, hi: int) -> tuple[int, int]:
        return _origin(parent, start + lo, start + hi)
    return origin


def inner_layers(parent: Layer | None, text: str, with_base64: bool = True) -> Iterator[Layer]:
    route = parent.route if parent else ()
    if parent and parent.steps >= STEPWISE:
        steps = [_resolved(parent, text)] if "%" in text or "\\" in text or "&#" in text else []
    else:
        steps = [_substituted(parent, text, PERCENT_RUN, _percent, "url")] if "%" in text else []
        if "\\" in text or "&#" in text:
            steps.append(_substituted(parent, text, ESCAPE, _escape, "escape"))
    yield from filter(None, steps)
    if with_base64:
        for m in [*BASE64.finditer(text), *WRAPPED.finditer(text)]:
            if parent is None or parent.is_new(*m.span()):
                yield from base64_layers(m.group().encode(), _inside(parent, m.start()), route)


def _decompressed(layer: Layer, closed: list[int]) -> Iterator[Layer]:
    """What compressed data hold, one content at a time; anything else in its readings as text."""
    data, whole, route = layer.content, layer.whole, layer.route
    layer.content = b""  # from here on kept by the reader alone, until it is read to the end
    for name, content in _unpacked(data):
        if content is None:
            closed.append(1)
        elif name:
            yield Layer(content, whole, (*route, name))
        else:
            yield from (Layer(t, whole, route) for t in _texts(content))


def unwrap(start: list[Layer]) -> tuple[list[tuple[int, int, int, str]], int]:
    """Work through layers until none is left: findings (kind, start, end, route) and the
    number of layers that stayed closed.

    The worklist is a stack of readers of layers: a layer's own layers are worked through before
    the next one is read, so that the contents of one compressed run are not all in memory.
    Content that came out of the same place before is not unwrapped again (cycles)."""
    found: list[tuple[int, int, int, str]] = []
    closed: list[int] = []
    done = set().union(*(layer.around for layer in start))
    stack: list[Iterator[Layer]] = [iter(start)]
    while stack:
        layer = next(stack[-1], None)
        if layer is None:
            stack.pop()
            continue
        key = layer.key()
        if key in done:
            continue
        done.add(key)
        if isinstance(layer.content, bytes):
            stack.append(_decompressed(layer, closed))
            continue
        for kind, lo, hi in scan(layer.content):
            if layer.is_new(lo, hi):
                found.append((kind, *layer.origin(lo, hi), "+".join(layer.route)))
        stack.append(inner_layers(layer, layer.content))
    return found, len(closed)


def findings(text: str, runs: list[tuple[int, int]] | None = None) -> tuple[list[dict], int]:
    """All findings of a text, base ones first by place, and the count of closed layers.

    ``runs``: (start, end) code points of its base64 runs, where already known.
    """
    base = scan(text)
    if runs is None:
        start = list(inner_layers(None, text))
    else:
        start = list(inner_layers(None, text, with_base64=False))
        for lo, hi in runs:
            start += base64_layers(text[lo:hi].encode(), _inside(None, lo), ())
    deeper, closed = unwrap(start) if start else ([], 0)
    seen = set(base)
    out = [(k, lo, hi, "") for k, lo, hi in base]
    for f in deeper:
        if f[:3] not in seen:
            seen.add(f[:3])
            out.append(f)
    out.sort(key=lambda f: (f[1], f[0], f[2]))
    return [{"kind": KINDS[k], "start": lo, "end": hi, "route": route, "base": not route,
             "found": text[lo:hi]} for k, lo, hi, route in out], closed


def _class(chars: str) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[np.frombuffer(chars.encode(), dtype=np.uint8)] = True
    return table


_HEX_BYTES = _class("0123456789abcdef")
_BASE64_BYTES = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")


def _long_runs(data: np.ndarray, borders: np.ndarray, table: np.ndarray, least: int) -> np.ndarray:
    """(start, end) of runs of the class with ``least`` bytes or more inside one text."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = table[data]
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    long = ends - starts >= least
    starts, ends = starts[long], ends[long]
    # a run over a border between texts is cut there
    pieces = []
    first, last = np.searchsorted(borders, starts, side="right"), np.searchsorted(borders, ends, side="left")
    for s, e, i, j in zip(starts.tolist(), ends.tolist(), first.tolist(), last.tolist()):
        if i == j:
            pieces.append((s, e))
            continue
        cuts = [s, *borders[i:j].tolist(), e]
        pieces += [(a, b) for a, b in zip(cuts, cuts[1:]) if b - a >= least]
    return np.array(pieces, dtype=np.int64).reshape(-1, 2)


FINDINGS = ("array<struct<kind:string,start:long,end:long,route:string,base:boolean,found:string>>")
_FINDING = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                      ("route", pa.string()), ("base", pa.bool_()), ("found", pa.string())])


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lo = 0
        data, offsets = utf8(batch.column("text"))
        while lo < batch.num_rows:
            hi = int(np.searchsorted(offsets, offsets[lo] + (1 << 20), side="right")) - 1
            hi = min(max(hi, lo + 1), batch.num_rows)
            yield _scan_block(batch.slice(lo, hi - lo), data[offsets[lo]:offsets[hi]],
                              offsets[lo:hi + 1] - offsets[lo])
            lo = hi


def _scan_block(part: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
    n = part.num_rows
    results, closed = [[]] * n, [0] * n
    raw = data.tobytes()
    hex_rows = set((np.searchsorted(offsets, _long_runs(data, offsets, _HEX_BYTES, MIN_HEX)[:, 0],
                                    side="right") - 1).tolist())
    encoded: dict[int, list[tuple[int, int]]] = {}
    for s, e in _long_runs(data, offsets, _BASE64_BYTES, MIN_BASE64).tolist():
        # most long runs are plain words: what they decode to holds nothing
        if base64_layers(raw[s:e], _inside(None, s), ()):
            row = int(np.searchsorted(offsets, s, side="right")) - 1
            while e < offsets[row + 1] and raw[e:e + 1] == b"=":
                e += 1
            encoded.setdefault(row, []).append((s, e))
    for i in range(n):
        own = raw[offsets[i]:offsets[i + 1]]
        for m in WRAPPED_BYTES.finditer(own):
            if m.end() - m.start() > MIN_BASE64 and base64_layers(m.group(), _inside(None, 0), ()):
                encoded.setdefault(i, []).append((int(offsets[i]) + m.start(), int(offsets[i]) + m.end()))
        low = own.lower()
        if not (i in hex_rows or i in encoded or b"%" in own or b"\\" in own or b"&#" in own
                or b"AKIA" in own or any(w.encode() in low for w in ASSIGN_WORDS)):
            continue
        text = own.decode("utf-8", "replace")
        start = int(offsets[i])
        runs = [(len(raw[start:s].decode("utf-8", "replace")), len(raw[start:e].decode("utf-8", "replace")))
                for s, e in encoded.get(i, [])]
        results[i], closed[i] = findings(text, runs)
    return pa.RecordBatch.from_arrays(
        [part.column("doc_id"), pa.array(results, pa.list_(_FINDING)), pa.array(closed, pa.int64())],
        names=["doc_id", "findings", "closed_layers"])


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, findings (kind, start, end, route, base, found), closed_layers."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = rows.mapInArrow(tidy(_scan_batches), f"doc_id long, findings {FINDINGS}, closed_layers long")
    return found.withColumnRenamed("doc_id", id_col)
