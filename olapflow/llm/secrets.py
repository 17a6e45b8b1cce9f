"""Secret scans through nested encodings.

Each text is a worklist of layers. A layer is scanned, then searched for encodings: URL
and Unicode escapes give the layer with those escapes decoded, Base64 blobs give their
content, unpacked if it is compressed; a blob may be of either alphabet and wrapped into
lines. New layers join the list until nothing new comes
up; a layer already seen is not entered again, which ends cycles. Every character of a
layer carries the span of the original text it came from, so findings in any layer are
reported as spans of the text itself. Bytes that are no text are no reason to leave a
layer out: each stands as one placeholder, and the patterns decide what is a finding.
"""

from __future__ import annotations

import binascii
import bz2
import hashlib
import html
import lzma
import re
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex")

#: Unpacked bytes that are held and scanned at once. A stream that unpacks to more is scanned
#: piece by piece, each with the last ``OVERLAP`` bytes of the one before, so that memory is
#: bounded and no secret is lost at a cut.
PIECE, OVERLAP = 1 << 26, 1 << 23

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")

#: Percent escapes; a percent sign that was escaped any number of times is one with what follows.
_URL = re.compile(r"(?:%(?:25)*+(?:[0-9A-Fa-f]{2}|(?<=25)))+")
_URL_BYTE = re.compile(r"%(?:25)*+([0-9A-Fa-f]{2})?")
#: What percent encoders write for bytes: escapes and characters left as they are.
_MIXED = re.compile(r"(?:%[0-9A-Fa-f]{2}|[!-$&-~])++")
_BYTE = re.compile(r"%([0-9A-Fa-f]{2})|.")
#: The same with percent signs that were escaped again.
_MIXED_AGAIN = re.compile(r"(?:%(?:25)*+(?:[0-9A-Fa-f]{2}|(?<=25))|[!-$&-~])++")
_BYTE_AGAIN = re.compile(r"%(?:25)*+(?:([0-9A-Fa-f]{2})|(?<=25))|.")
_UNICODE = re.compile(
    r"(?:\\u[0-9A-Fa-f]{4})+|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|&#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});"
)

_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_"
_STANDARD = str.maketrans("-_", "+/")
#: Runs of Base64 digits of both alphabets, and the runs of one alphabet inside them.
_RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
_ONE = (re.compile(r"[A-Za-z0-9+/]{16,}={0,2}"), re.compile(r"[A-Za-z0-9_-]{16,}={0,2}"))
_CUT = re.compile(r"[A-Za-z0-9+/]{16,}={0,2}|[A-Za-z0-9_-]{16,}={0,2}")
_LINE, _LAST = re.compile(r"[A-Za-z0-9+/_-]+"), re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
#: Line breaks, real, continued or escaped, with the indent of the next line.
_BREAK = re.compile(r"(?:\n|\r|\\\\*+[nr\n\r])(?:[ \t\n\r]|\\++[nr\n\r])*+")
_STEP, _PART = 1 << 14, 1 << 20  # bytes unpacked at a time, and bytes got from them
_PACKED = re.compile(rb"\x1f\x8b\x08|x[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\x00")


def scan(text: str) -> Iterator[tuple[int, int, int]]:
    """Findings in one layer as (start, kind's place in KINDS, end), leftmost per kind."""
    if "=" in text or ":" in text:
        for m in _ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= 6:
                yield m.start(), 0, m.end()
    if "AKIA" in text:
        for m in _ACCESS.finditer(text):
            yield m.start(), 1, m.end()
    for m in _HEX.finditer(text):
        yield m.start(), 2, m.end()


class _Layer:
    """A text and, per character, where it starts and ends in the original text."""

    def __init__(self, text: str, starts: np.ndarray, ends: np.ndarray):
        self.text, self.starts, self.ends = text, starts, ends

    @classmethod
    def whole(cls, text: str) -> _Layer:
        at = np.arange(len(text), dtype=np.int64)
        return cls(text, at, at + 1)

    @classmethod
    def inside(cls, text: str, start: int, end: int) -> _Layer:
        """Every character of ``text`` stands for the whole span."""
        return cls(text, np.broadcast_to(np.int64(start), len(text)), np.broadcast_to(np.int64(end), len(text)))


#: Stands for a byte or half of a pair that is no text.
BAD = "\ufffd"
_BAD = re.compile("[\ud800-\udfff]")


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _decoded(data: bytes) -> tuple[str, np.ndarray]:
    """``data`` as text, one BAD for each byte that is not UTF-8, and the bytes of each character."""
    if data.isascii():
        return data.decode("ascii"), np.ones(len(data), np.int64)
    text = data.decode("utf-8", "surrogateescape")
    codes = _codes(text)
    sizes = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
    sizes[(codes >= 0xD800) & (codes < 0xE000)] = 1
    return _BAD.sub(BAD, text), sizes


def _url_part(part: str) -> tuple[str, np.ndarray]:
    tokens = list(_URL_BYTE.finditer(part))
    text, sizes = _decoded(bytes(int(t.group(1) or "25", 16) for t in tokens))
    ends = np.array([t.end() for t in tokens])[np.cumsum(sizes) - 1]
    return text, np.diff(ends, prepend=0)


def _unicode_part(part: str) -> tuple[str, np.ndarray | None]:
    if part.startswith("&#"):
        return html.unescape(part), None
    if part.startswith(("\\u{", "\\U")):
        code = int(part[2:].strip("{}"), 16)
        return chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else BAD, None
    if part.startswith("\\x"):
        return chr(int(part[2:], 16)), None
    # pairs of surrogates give one character
    text = bytes.fromhex(part.replace("\\u", "")).decode("utf-16-be", "surrogatepass")
    return _BAD.sub(BAD, text), 6 * (1 + (_codes(text) >= 0x10000).astype(np.int64))


def _unescaped(layer: _Layer, pattern: re.Pattern, decode) -> _Layer | None:
    """The layer with every escape that ``pattern`` finds decoded; None if there is none."""
    texts, starts, ends, at = [], [], [], 0
    for m in pattern.finditer(layer.text):
        new, sizes = decode(m.group())
        if not new:
            continue
        if sizes is None:  # all of it stands for the whole escape
            upto = np.full(len(new), m.end())
            sizes = upto - m.start()
        else:
            upto = m.start() + np.cumsum(sizes)
        texts += [layer.text[at : m.start()], new]
        starts += [layer.starts[at : m.start()], layer.starts[upto - sizes]]
        ends += [layer.ends[at : m.start()], layer.ends[upto - 1]]
        at = m.end()
    if not texts:
        return None
    texts.append(layer.text[at:])
    return _Layer("".join(texts), np.concatenate([*starts, layer.starts[at:]]), np.concatenate([*ends, layer.ends[at:]]))


def _inflated(data: bytes, at: int) -> Iterator[bytes | int]:
    """Content of the gzip, zlib, bzip2 or xz data that starts at ``at``, in small parts, then
    where it ends. Raises an error if it is none of them or is cut off."""
    head = data[at : at + 1]
    machine = zlib.decompressobj(47) if head in b"\x1fx" else bz2.BZ2Decompressor() if head == b"B" else lzma.LZMADecompressor()
    while not machine.eof and at < len(data):  # in steps, as what follows the end is copied
        step = data[at : at + _STEP]
        at += len(step)
        while True:
            if part := machine.decompress(step, _PART):
                yield part
            step = machine.unconsumed_tail if head in b"\x1fx" else b""
            if machine.eof or (not step if head in b"\x1fx" else machine.needs_input):
                break
    if not machine.eof:
        raise EOFError
    yield at - len(machine.unused_data)


def _unpacked(data: bytes, at: int) -> tuple[int, int, bytes | None] | None:
    """End, unpacked size and, up to ``PIECE`` bytes, content of the stream that starts at
    ``at``; None if there is none."""
    parts: list[bytes] = []
    size, end = 0, at
    try:
        for part in _inflated(data, at):
            if isinstance(part, int):
                end = part
                continue
            size += len(part)
            if size > PIECE:
                parts.clear()
            else:
                parts.append(part)
    except (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError):
        return None
    return end, size, b"".join(parts) if size <= PIECE else None


def _pieces(data: bytes, starts: list[int]) -> Iterator[bytes]:
    """Content of large streams that follow each other, unpacked once more, in pieces that
    overlap."""
    held = b""
    for start in starts:
        for part in _inflated(data, start):
            if isinstance(part, int):
                continue
            held += part
            while len(held) > PIECE:
                yield held[:PIECE]
                held = held[PIECE - OVERLAP :]
    yield held


def _streams(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Start, end and content of the compressed streams inside ``data``, members that follow
    each other joined; content over ``PIECE`` bytes comes in overlapping pieces."""
    starts: list[int] = []
    parts: list[bytes] = []
    end = at = size = 0

    def joined() -> Iterator[tuple[int, int, bytes]]:
        if starts:
            for content in [b"".join(parts)] if size <= PIECE else _pieces(data, starts):
                yield starts[0], end, content

    while m := _PACKED.search(data, at):
        at = m.start() + 1
        if one := _unpacked(data, m.start()):
            if m.start() != end:
                yield from joined()
                starts, parts, size = [], [], 0
            starts.append(m.start())
            size += one[1]
            if size <= PIECE:
                parts.append(one[2])
            else:
                parts.clear()
            end = at = one[0]
    yield from joined()


def _contents(data: bytes) -> Iterator[tuple[int, int, str]]:
    """Like ``_streams``, as text, with the streams inside of streams."""
    work, seen = deque([(None, None, _streams(data))]), set()
    while work:
        start, end, inner = work.popleft()
        for first, last, content in inner:
            place = (first, last) if start is None else (start, end)
            mark = (place[0], hashlib.blake2b(content, digest_size=16).digest())
            if mark in seen:
                continue
            seen.add(mark)
            yield *place, _BAD.sub(BAD, content.decode("utf-8", "surrogateescape"))
            if _PACKED.search(content):
                work.append((*place, _streams(content)))


def _wrapped(text: str) -> Iterator[list[tuple[int, int]]]:
    """Spans of the lines of digits that line breaks part."""
    lines: list[tuple[int, int]] = []
    floor = 0
    for m in _BREAK.finditer(text):
        end = m.start()
        while end > floor and text[end - 1] in " \t":
            end -= 1
        body = text[floor:end]
        if lines and _LINE.fullmatch(body):
            lines.append((floor, end))
        else:
            if last := _LAST.match(body):
                lines.append((floor, floor + last.end()))
            if len(lines) > 1:
                yield lines
            head = floor + len(body.rstrip(_DIGITS))
            lines = [(head, end)] if head < end else []
        floor = m.end()
    if last := _LAST.match(text, floor):
        lines.append(last.span())
    if len(lines) > 1:
        yield lines


def _runs(text: str) -> Iterator[list[tuple[int, int]]]:
    """Where Base64 blobs may lie, each as the spans of its lines.

    A run of digits is taken whole and, as what stands before a blob may be digits too, by
    its parts of one alphabet. Lines are taken alone and joined. Joined lines start at the
    first line, at a later one or inside the first after a mark, as often as that puts the
    digits in other groups of four.
    """
    for m in _RUN.finditer(text):
        run, spans = m.group(), [m.span()]
        if "-" in run or "_" in run or "+" in run or "/" in run:
            spans += [p.span() for pattern in (*_ONE, _CUT) for p in pattern.finditer(text, *m.span())]
        if run[0] in "nrt" and text[m.start() - 1 : m.start()] == "\\":  # the end of an escape
            spans.append((m.start() + 1, m.end()))
        for span in dict.fromkeys(spans):
            yield [span]
    for lines in _wrapped(text):
        if sum(end - start for start, end in lines) < 16:
            continue
        groups, at = set(), 0
        for i, (start, end) in enumerate(lines):
            marks = (m.end() for m in re.finditer(r"[+/_-]", text[start:end])) if i == 0 else ()
            for skip in (0, *marks):
                if (at + skip) % 4 not in groups and skip < end - start:
                    groups.add((at + skip) % 4)
                    yield [(start + skip, end), *lines[i + 1 :]]
            at += end - start
            if len(groups) == 4:
                break


def _blobs(layer: _Layer) -> Iterator[_Layer]:
    """Layers inside the Base64 blobs of a layer."""
    for lines in _runs(layer.text):
        digits = "".join(layer.text[a:b] for a, b in lines).rstrip("=").translate(_STANDARD)
        size = len(digits) - (len(digits) % 4 == 1)
        if size < 16:
            continue
        data = binascii.a2b_base64(digits[:size] + "=" * (-size % 4))
        places = np.concatenate([np.arange(a, b) for a, b in lines])[:size]
        starts, ends = layer.starts[places], layer.ends[places]
        ends[-1] = layer.ends[lines[-1][1] - 1]  # with the padding
        for first, last, text in _contents(data):
            yield _Layer.inside(text, int(starts[first // 3 * 4]), int(ends[min((last + 2) // 3 * 4, size) - 1]))
        text, sizes = _decoded(data)
        upto = np.cumsum(sizes)  # three bytes for every four digits
        yield _Layer(text, starts[(upto - sizes) // 3 * 4], ends[np.minimum((upto - 1) // 3 * 4 + 3, size - 1)])


def _escaped_streams(layer: _Layer) -> Iterator[_Layer]:
    """Layers inside compressed bytes that are written as they are or as percent escapes,
    escaped once or any number of times."""
    ways = [(_MIXED, _BYTE)] if "%" in layer.text else []
    for run, byte in [*ways, (_MIXED_AGAIN, _BYTE_AGAIN)] if "%25" in layer.text else ways:
        for m in run.finditer(layer.text):
            if "%" not in m.group():
                continue
            tokens = list(byte.finditer(m.group()))
            plain = bytes(int(t.group(1), 16) if t.group(1) else ord(t.group()[0]) for t in tokens)
            plus = {i for i, t in enumerate(tokens) if t.group() == "+"}  # may stand for a blank
            other = bytes(32 if i in plus else c for i, c in enumerate(plain)) if plus else plain
            for data in {plain, other}:
                if not _PACKED.search(data):
                    continue
                places = [m.start() + t.start() for t in tokens] + [m.end()]
                for first, last, text in _contents(data):
                    yield _Layer.inside(text, int(layer.starts[places[first]]), int(layer.ends[places[last] - 1]))


def _digest(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def find_secrets(text: str) -> list[tuple[int, int, int, int]]:
    """All findings as (start, kind, end, depth), each span once, with its least depth."""
    found: dict[tuple[int, int, int], int] = {}
    for start, kind, end in scan(text):
        found[start, kind, end] = 0
    work, seen = deque([(_Layer.whole(text), 0)] if _encoded(text) else []), set()
    while work:
        layer, depth = work.popleft()
        mark = (_digest(layer.text), int(layer.starts[0]), int(layer.ends[-1]))
        if mark in seen:
            continue
        seen.add(mark)
        if depth:
            for start, kind, end in scan(layer.text):
                span = int(layer.starts[start]), kind, int(layer.ends[end - 1])
                found[span] = min(depth, found.get(span, depth))
        inner = [
            _unescaped(layer, _URL, _url_part), _unescaped(layer, _UNICODE, _unicode_part),
            *_blobs(layer), *_escaped_streams(layer),
        ]
        work += [(new, depth + 1) for new in inner if new is not None and new.text]
    return sorted((*span, depth) for span, depth in found.items())


def _encoded(text: str) -> bool:
    return bool(
        ("%" in text and _URL.search(text)) or (("\\" in text or "&#" in text) and _UNICODE.search(text)) or next(_runs(text), None)
    )


def scan_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``secrets``: an array of (kind, start, end, depth), by start and kind.

    Offsets count code points and ends are exclusive. Depth 0 is the text itself, depth 1
    what one decoding reveals, and so on. A null or empty text has none; an empty table
    gives an empty result; repeated rows get equal findings. An input column named secrets
    is replaced. Texts are scanned whole; a finding inside compressed data is reported as
    the span of the blob that holds it.
    """

    @F.arrow_udf("array<struct<kind:string,start:long,end:long,depth:int>>")
    def findings(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("depth", pa.int32())])
        for batch in texts:
            rows = []
            for value in batch.to_pylist():
                rows.append([
                    {"kind": KINDS[k], "start": start, "end": end, "depth": depth}
                    for start, k, end, depth in (find_secrets(value) if value else [])
                ])
            yield pa.array(rows, pa.list_(kind))

    return docs.withColumn("secrets", findings(F.col(text).cast("string")))
