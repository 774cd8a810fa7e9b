"""Secret scans with a recursive decoding worklist (operator 9).

A text is the first layer. Each layer is scanned for secrets and unwrapped: percent
escapes, Unicode and character escapes, base64 runs (also wrapped ones, and those behind
other characters of the alphabet), UTF-16 text, and gzip or zlib streams that begin anywhere inside
base64 or percent escapes. What an unwrapping yields is a new layer on the worklist, with the place in the
text each of its characters comes from, until nothing new turns up; a layer seen before
(the same content from the same place) is not taken again, which ends cycles. A span
found in a layer is reported where its characters stand in the text. Bytes that are no UTF-8
and lone surrogates become U+FFFD; what stands around them is kept.

A stream is unpacked in windows of `WINDOW` bytes that overlap by `OVERLAP`, whatever it holds in
all; its place is one range, the stream's, so a window needs no place for each character.

Spans of the text itself are the base spans; those of deeper layers are added to them.
A secret's kind is `assign`, `access` or `hex`.

Defined results: a null text counts as empty and has no spans; every row is scanned by
itself, so repeated rows give equal results; texts and streams are scanned whole. A stream
inside a stream that crosses a window's end is read as far as the overlap shows it.
Other columns of the input are kept by `scan`.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from urllib.parse import unquote_to_bytes

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

WINDOW, OVERLAP = 1 << 20, 1 << 16

# Fixed: the kinds and their patterns, with the least length of group `part`.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LEAST, ACCESS_LEAST = 8, 16

_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
# Long runs: the only places of hex secrets and of base64. 18 characters of base64 hold 13 bytes,
# one less than the shortest secret.
_RUN = re.compile(r"[A-Za-z0-9+/_-]{18,}={0,2}")
# Fixed: the first bytes of gzip, and those a zlib header may have (method 8, window of up to
# 32 KB, no dictionary); the two together must be a multiple of 31.
_GZIP = b"\x1f\x8b\x08"
_MAGIC = re.compile(
    rb"\x1f\x8b\x08|[\x08\x18\x28\x38\x48\x58\x68\x78](?=[\x00-\x1f\x40-\x5f\x80-\x9f\xc0-\xdf])", re.DOTALL
)
# Letters with zero bytes between them.
_WIDE = re.compile(rb"(?:[\x20-\x7e]\x00){8}")
# Adjacent lines of base64: all but the first are whole lines.
_WRAPPED = re.compile(
    r"[A-Za-z0-9+/_-]++(?:[\x20\t]*\r?\n[\x20\t]*[A-Za-z0-9+/_-]++(?![\x20\t]+[^\s]))+={0,2}"
)
# What a decoded text must have for a secret or a further layer to be in it.
_WORTH = re.compile(rb"(?i:passw|secret|token|api_?key)|AKIA|%[0-9A-Fa-f]{2}|\\|&#|[A-Za-z0-9+/_-]{18}|[A-Za-z0-9+/_-]\s+[A-Za-z0-9+/_-]")
# What percent escapes of arbitrary bytes look like, with the characters that need none.
_ESCAPED_BYTES = re.compile(r"[!-$&-~]*(?:%[0-9A-Fa-f]{2}[!-$&-~]*){4,}")
_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(
    r"(?:\\u[0-9A-Fa-f]{4})+|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};"
)

SPANS = ArrayType(
    StructType(
        [
            StructField("kind", StringType(), False),
            StructField("start", IntegerType(), False),
            StructField("end", IntegerType(), False),
            StructField("base", BooleanType(), False),
        ]
    ),
    False,
)

# Where the characters of a layer come from: the text itself (None), one range for all of them, or
# the first and the last place of each.
Places = tuple[int, int] | tuple[array, array] | None


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`row` (the input row without the text) and `spans`, by start, kind as listed, and end."""
    rest = [c for c in docs.columns if c != text_col]
    rows = docs.select(F.col(text_col).alias("text"), F.struct(*rest).alias("row"))
    schema = StructType([rows.schema["row"], StructField("spans", SPANS, False)])
    return rows.mapInArrow(_scan_batches, schema)


def span_text(spans: str = "spans"):
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def _scan_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.struct(
        [
            pa.field("kind", pa.string(), False),
            pa.field("start", pa.int32(), False),
            pa.field("end", pa.int32(), False),
            pa.field("base", pa.bool_(), False),
        ]
    )
    for batch in batches:
        found = [find_spans(text.as_py() or "") for text in batch.column("text")]
        spans = pa.array(
            [[{"kind": KINDS[k], "start": s, "end": e, "base": b} for s, k, e, b in x] for x in found],
            pa.list_(pa.field("element", kind, False)),
        )
        yield pa.RecordBatch.from_arrays([batch.column("row"), spans], names=["row", "spans"])


def find_spans(text: str) -> list[tuple[int, int, int, bool]]:
    """(start, kind number, end, whether a base span) in order, without repeats."""
    base = set(_matches(text))
    found = {span: True for span in base}
    work = [_unwrap(text, None)]
    seen: set = set()
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        inner, where = layer
        whole = _place(where, 0, len(inner))
        mark = (hashlib.blake2b(inner.encode(), digest_size=16).digest(), whole)
        if mark in seen:
            continue
        seen.add(mark)
        work.append(_unwrap(inner, where))
        for start, kind, end in _matches(inner):
            first, last = _place(where, start, end)
            found.setdefault((first, kind, last), False)
    return [(*span, found[span]) for span in sorted(found)]


def _matches(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the secrets in one layer."""
    out = []
    low = text.lower()
    if any(name in low for name in _NAMES):
        out += [
            (m.start(), 0, m.end())
            for m in ASSIGN.finditer(text)
            if m.end(2) - m.start(2) >= ASSIGN_LEAST
        ]
    if "AKIA" in text:
        out += [
            (m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST
        ]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return out


def _unwrap(text: str, places: Places) -> Iterator[tuple[str, Places]]:
    if "%" in text and _PERCENT.search(text):
        yield from _rewritten(text, places, _PERCENT, _percent)
        for run in _ESCAPED_BYTES.finditer(text):
            yield from _streams(unquote_to_bytes(run.group()), lambda _: run.start(), run.end(), places)
    if ("\\" in text or "&#" in text) and _ESCAPE.search(text):
        yield from _rewritten(text, places, _ESCAPE, _escape)
    for run in _RUN.finditer(text):
        yield from _base64(run.group(), run.start(), places)
    if "\n" in text:
        for run in _WRAPPED.finditer(text):
            if len(run.group()) >= 18:
                yield from _base64(run.group(), run.start(), places)


def _place(places: Places, start: int, end: int) -> tuple[int, int]:
    if places is None:
        return start, end
    if isinstance(places[0], int):
        return places
    return places[0][start], places[1][end - 1]


def _rewritten(text, places, pattern, decode):
    """The whole layer with every match of `pattern` decoded."""
    parts, starts, ends = [], array("i"), array("i")
    one = places is not None and isinstance(places[0], int)
    at = 0

    def plain(begin: int, end: int) -> None:
        parts.append(text[begin:end])
        if places is None:
            starts.extend(range(begin, end))
            ends.extend(range(begin + 1, end + 1))
        elif not one:
            starts.extend(places[0][begin:end])
            ends.extend(places[1][begin:end])

    for match in pattern.finditer(text):
        plain(at, match.start())
        for char, begin, end in decode(match.group()):
            parts.append(char)
            if not one:
                first, last = _place(places, match.start() + begin, match.start() + end)
                starts.append(first)
                ends.append(last)
        at = match.end()
    plain(at, len(text))
    inner = "".join(parts)
    if inner:
        yield inner, places if one else (starts, ends)


def _percent(escapes: str):
    """(character, begin, end) of a run of percent escapes."""
    data = bytes.fromhex(escapes.replace("%", ""))
    at = 0
    for char, size in _sizes(data, data.decode("utf-8", "replace")):
        yield char, at, at + 3 * size
        at += 3 * size


def _escape(escape: str):
    if escape.startswith("\\u") and not escape.startswith("\\u{"):
        units = [int(escape[i + 2 : i + 6], 16) for i in range(0, len(escape), 6)]
        i = 0
        while i < len(units):
            pair = i + 1 < len(units) and 0xD800 <= units[i] < 0xDC00 <= units[i + 1] < 0xE000
            code = 0x10000 + ((units[i] - 0xD800) << 10) + units[i + 1] - 0xDC00 if pair else units[i]
            yield _char(code), 6 * i, 6 * (i + 1 + pair)
            i += 1 + pair
        return
    digits = escape.strip("\\{}&#;uUxX")
    code = int(digits, 10 if escape.startswith("&#") and escape[2] not in "xX" else 16)
    yield _char(code), 0, len(escape)


def _char(code: int) -> str:
    return chr(code) if code <= 0x10FFFF and not 0xD800 <= code < 0xE000 else "\ufffd"


def _base64(run: str, at: int, places: Places):
    """What a run holds, read from each of its first four characters: base64 may begin within it."""
    chars, spots = [], array("i")
    for piece in re.finditer(r"[^\s=]+", run):
        chars.append(piece.group())
        spots.extend(range(at + piece.start(), at + piece.end()))
    body = "".join(chars).replace("-", "+").replace("_", "/")
    one = places is not None and isinstance(places[0], int)
    for phase in range(4):
        part = body[phase:]
        if len(part) % 4 == 1:
            part = part[:-1]
        data = base64.b64decode(part + "=" * (-len(part) % 4))
        yield from _streams(data, lambda byte, phase=phase: spots[phase + byte * 4 // 3], at + len(run), places)
        if wide := _WIDE.search(data):
            # Read as letters only, from the first such run on.
            kept = [i for i in range(wide.start(), len(data)) if data[i]]
            letters = bytes(data[i] for i in kept)
            yield from _decoded(letters, kept, len(letters), phase, spots, places, one)
        if _WORTH.search(data):
            yield from _decoded(data, range(len(data)), len(data), phase, spots, places, one)


def _decoded(data, at, size, phase, spots, places, one):
    """Bytes of a base64 run as text; `at` tells where each stands in the run's bytes."""
    text = data.decode("utf-8", "replace")
    if one:
        yield text, places
        return
    starts, ends, byte = array("i"), array("i"), 0
    for _, many in _sizes(data, text):
        first, last = at[byte], at[byte + many - 1]
        begin, end = _place(
            places, spots[phase + first * 4 // 3], spots[phase + -(-(last + 1) * 4 // 3) - 1] + 1
        )
        starts.append(begin)
        ends.append(end)
        byte += many
    yield text, (starts, ends)


def _sizes(data: bytes, text: str) -> Iterator[tuple[str, int]]:
    """Each character of a text decoded with replacements, and the bytes it stands for."""
    at = 0
    for char in text:
        size = len(char.encode())
        if char == "\ufffd" and data[at : at + 3] != b"\xef\xbf\xbd":
            size = 1
            while at + size < len(data) and data[at : at + size + 1].decode("utf-8", "replace") == char:
                size += 1
        yield char, size
        at += size


def _streams(data: bytes, spot, end: int, places: Places) -> Iterator[tuple[str, Places]]:
    """Windows of the streams that begin in `data`; `spot` gives the place of a byte, `end` is theirs."""
    view = memoryview(data)
    behind = 0
    for magic in _MAGIC.finditer(data):
        begin = magic.start()
        if begin < behind or magic.group() != _GZIP and (data[begin] << 8 | data[begin + 1]) % 31:
            continue
        tail = b""
        for chunk, used in _unpacked(view[begin:]):
            window = tail + chunk
            yield window.decode("utf-8", "replace"), _place(places, spot(begin), end)
            tail = window[-OVERLAP:]
            # Bytes of a stream that came out are not tried again as beginnings.
            behind = begin + used


def _unpacked(data: memoryview) -> Iterator[tuple[bytes, int]]:
    """What a zlib stream or the members of a gzip stream hold, in chunks, with the bytes read so far."""
    at = 0
    while True:
        stream = zlib.decompressobj(zlib.MAX_WBITS | 32)
        while not stream.eof and at < len(data):
            fed = data[at : at + OVERLAP]
            try:
                out = stream.decompress(fed, WINDOW)
            except zlib.error:
                return
            at += len(fed) - len(stream.unconsumed_tail) - len(stream.unused_data)
            if out:
                yield out, at
        # The rest of what a stream holds back once its input is read.
        while not stream.eof and (out := stream.decompress(b"", WINDOW)):
            yield out, at
        if not stream.eof or bytes(data[at : at + 3]) != _GZIP:
            return
