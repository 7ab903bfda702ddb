"""Secret scan with a recursive decoding worklist.

Three kinds of secrets are looked for in a text and in every layer that can be decoded
from it: URL escapes (``%uXXXX`` too), Unicode and hexadecimal escapes of four, eight or any
digits, numbered and named character references, base64, hex text, text in UTF-16, and gzip
or zlib streams.  Layers are texts or bytes; both go on a worklist and are scanned and decoded in
turn until nothing new appears; a layer that was seen before (same content from the same
stretch) is not read again, so layers that decode to each other end, and a secret that is
encoded alike in several places is found in each of them.  Every character of a layer knows
the stretch of the original text that it came from, and a finding is reported as that
stretch.

A run of base64 characters is read at its four alignments, so what is glued before it does
not matter; lines that follow each other are read one by one and joined.  Streams are looked
for at every byte of a layer, one behind the other, whatever they were wrapped in.  Bytes
that are no text stay in a layer as single characters, the text around them is read.

Defined results: null and empty texts hold nothing; texts are read whole; repeated texts
get the same result; streams inside streams are all followed (what they expand to is not
limited in all); of a damaged gzip stream the part before the damage is read.
"""

from __future__ import annotations

import binascii
import re
import zlib
from html.entities import html5

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunesmith.llm.common import add_columns, prepare, quoted

KINDS = ("assign", "access", "hex")
#: Bytes at once while a stream is expanded.
CHUNK = 1 << 14

ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a maximal run: shorter runs would be dropped
KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
#: Named references of one ASCII character; findings hold no others.
NAMES = {n[:-1]: ord(c) for n, c in html5.items() if n.endswith(";") and len(c) == 1 and c.isascii()}
ESCAPE_PART = re.compile(
    r"(?:\\u|%u)(?P<four>[0-9A-Fa-f]{4})|\\x(?P<two>[0-9A-Fa-f]{2})|\\U(?P<eight>[0-9A-Fa-f]{8})"
    r"|\\[ux]\{(?P<any>[0-9A-Fa-f]{1,6})\}|&#[xX](?P<ref>[0-9A-Fa-f]{1,6});|&#(?P<num>[0-9]{1,7});"
    rf"|&(?P<name>{'|'.join(sorted(NAMES))});"
)
ESCAPE = re.compile(f"(?:{re.sub('[?]P<[a-z]+>', '?:', ESCAPE_PART.pattern)})+")
#: Escapes of one sign, which stand between the others in the source form of byte strings.
SIGN = re.compile(r"\\(?:[abefnrtv\\'\"/]|[0-7]{1,3})")
SIGNS = dict(zip("abefnrtv", b"\a\b\x1b\f\n\r\t\v"))
BYTE_PART = re.compile(ESCAPE_PART.pattern + "|" + r"\\(?P<sign>[abefnrtv\\'\"/])|\\(?P<octal>[0-7]{1,3})")
BYTES = re.compile(f"(?:{re.sub('[?]P<[a-z]+>', '?:', BYTE_PART.pattern)})+")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}")
NEXT_LINE = re.compile(r"[ \t]*(?:\r?\n|(?:\\r)?\\n)[ \t>]*([A-Za-z0-9+/_-]++)")
WHOLE_LINE = re.compile(NEXT_LINE.pattern + r"(?![ \t]*[A-Za-z0-9]|[,.;:!?])")
LINE_BEFORE = re.compile(r"([A-Za-z0-9+/_-]+)[ \t]*\r?\n[ \t>]*\Z")
URL_SAFE = str.maketrans("-_", "+/")
HEX_TEXT = re.compile(r"[0-9A-Fa-f]{32,}")
#: No finding, and nothing that decodes to one, is shorter than 14 such bytes in a row.
WORTH = re.compile(rb"[\t\n\f\r\x1b\x20-\x7e]{14,}")
#: The same in UTF-16, low or high byte first.
WIDE = re.compile(rb"(?:[\t\n\f\r\x1b\x20-\x7e]\x00){14,}|(?:\x00[\t\n\f\r\x1b\x20-\x7e]){14,}")
WIDE_TEXT = re.compile(WIDE.pattern.decode())
UNREAD = re.compile("[^\t\n\f\r\x1b\x20-\x7e]")
#: What a stream begins with: gzip's magic bytes, or a zlib head without dictionary.
STREAM = re.compile(b"\x1f\x8b\x08|" + b"|".join(
    re.escape(bytes((a, b))) for a in range(8, 128, 16) for b in range(256) if (a << 8 | b) % 31 == 0 and not b & 32
), re.S)

ADDED = (
    "base array<struct<kind: string, start: bigint, end: bigint>>, "
    "secrets array<struct<kind: string, start: bigint, end: bigint, layer: string>>"
)


def matches(text: str) -> list[tuple[str, int, int]]:
    """Findings in one layer: ``(kind, start, end)``."""
    found = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return found


class Layer:
    """A text or bytes and, for each character or byte, where it starts and ends in the
    original.  Bytes that are no UTF-8 are lone surrogates in a text."""

    __slots__ = ("text", "starts", "ends", "way")

    def __init__(self, text, starts, ends, way):
        self.text, self.starts, self.ends, self.way = text, starts, ends, way


class _Same:
    """One place for all characters of a layer."""

    __slots__ = ("at", "n")

    def __init__(self, at, n):
        self.at, self.n = at, n

    def __len__(self):
        return self.n

    def __getitem__(self, i):
        return [self.at] * len(range(*i.indices(self.n))) if isinstance(i, slice) else self.at


def _text(raw: bytes) -> tuple[str, list[int] | None]:
    """Bytes as a text, and the first byte of each character (None: each is one byte)."""
    if raw.isascii():
        return raw.decode("ascii"), None
    text = raw.decode("utf-8", "surrogateescape")
    at, offsets = 0, []
    for c in text:
        offsets.append(at)
        at += 1 if c < "\x80" or "\udc80" <= c <= "\udcff" else len(c.encode())
    return text, [*offsets, at]


def _readable(layer: Layer) -> Layer:
    """A layer of bytes as a text."""
    text, offsets = _text(layer.text)
    if offsets is None or isinstance(layer.starts, _Same):
        return Layer(text, _cut(layer.starts, len(text)), _cut(layer.ends, len(text)), layer.way)
    starts = [layer.starts[a] for a in offsets[:-1]]
    return Layer(text, starts, [layer.ends[b - 1] for b in offsets[1:]], layer.way)


def _cut(places, n: int):
    return _Same(places.at, n) if isinstance(places, _Same) else places


class _Late:
    """Places of the bytes of a text, found when a byte is asked for."""

    def __init__(self, places, text, points):
        self.places, self.text, self.points, self.upto = places, text, points, None

    def __getitem__(self, i):
        if self.upto is None:
            code = np.frombuffer(self.text.encode("utf-32-le", "surrogatepass"), "<u4")
            size = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)
            size[(code >= 0xDC80) & (code < 0xDD00) | (code < 0x100) & self.points] = 1
            self.upto = np.cumsum(size)
        return self.places[int(np.searchsorted(self.upto, i, "right"))]


def _bytes(layer: Layer, points: bool = False) -> Layer:
    """A layer of text as bytes.  ``points``: characters up to 255 are bytes themselves."""
    text = layer.text
    if points:
        parts = re.split("([^\x00-\xff]+)", text)
        raw = b"".join(p.encode("utf-8", "surrogateescape") if i % 2 else p.encode("latin-1") for i, p in enumerate(parts))
    else:
        raw = text.encode("utf-8", "surrogateescape")
    return Layer(raw, _Late(layer.starts, text, points), _Late(layer.ends, text, points), layer.way)


def _unescape(layer: Layer, pattern: re.Pattern, decode, way: str) -> Layer | None:
    """The layer with all stretches of a pattern decoded in place."""
    text, parts, starts, ends, done = layer.text, [], [], [], 0
    for m in pattern.finditer(text):
        chars, spans = decode(m.group())
        parts += [text[done : m.start()], chars]
        starts += layer.starts[done : m.start()] if layer.starts else range(done, m.start())
        ends += layer.ends[done : m.start()] if layer.ends else range(done + 1, m.start() + 1)
        for a, b in spans:
            starts.append(layer.starts[m.start() + a] if layer.starts else m.start() + a)
            ends.append(layer.ends[m.start() + b - 1] if layer.ends else m.start() + b)
        done = m.end()
    if not parts:
        return None
    parts.append(text[done:])
    starts += layer.starts[done:] if layer.starts else range(done, len(text))
    ends += layer.ends[done:] if layer.ends else range(done + 1, len(text) + 1)
    return Layer("".join(parts), starts, ends, layer.way + way)


def _percent(run: str):
    text, offsets = _text(bytes.fromhex(run.replace("%", "")))
    offsets = offsets or range(len(text) + 1)
    return text, [(3 * a, 3 * b) for a, b in zip(offsets[:-1], offsets[1:])]


def _escapes(run: str):
    units = []
    for m in BYTE_PART.finditer(run):
        kind, value = m.lastgroup, m[m.lastgroup]
        if kind == "num":
            code = int(value)
        elif kind == "name":
            code = NAMES[value]
        elif kind == "octal":
            code = int(value, 8) & 255
        elif kind == "sign":
            code = SIGNS.get(value, ord(value))
        else:
            code = int(value, 16)
        units.append((code, m.start(), m.end(), kind in ("two", "sign", "octal")))
    if all(u[3] for u in units) and any(u[0] > 127 for u in units):  # bytes, of UTF-8 or not
        text, offsets = _text(bytes(u[0] for u in units))
        return text, [(units[a][1], units[b - 1][2]) for a, b in zip(offsets[:-1], offsets[1:])]
    chars, spans, i = [], [], 0
    while i < len(units):
        code, a, b, _ = units[i]
        if 0xD800 <= code < 0xDC00 and i + 1 < len(units) and 0xDC00 <= units[i + 1][0] < 0xE000:
            code, b = 0x10000 + (code - 0xD800) * 1024 + units[i + 1][0] - 0xDC00, units[i + 1][2]
            i += 1
        chars.append("�" if 0xD800 <= code < 0xE000 or code > 0x10FFFF else chr(code))
        spans.append((a, b))
        i += 1
    return "".join(chars), spans


def _inflate(raw: bytes, at: int) -> tuple[int, bytes] | None:
    """End and content of the stream that starts at ``at``."""
    packed = raw[at] == 0x1F
    work, out, to = zlib.decompressobj(31 if packed else 15), [], at
    try:
        while not work.eof and to < len(raw):
            part, before = raw[to : to + CHUNK], work.copy() if packed else None
            out.append(work.decompress(part))
            to += len(part)
    except zlib.error:
        if not packed:
            return None
        try:  # what comes before the damage
            for i in range(len(part)):
                out.append(before.decompress(part[i : i + 1]))
        except zlib.error:
            return (at + 3, b"".join(out))
    if work.eof:
        return to - len(work.unused_data), b"".join(out)
    return (at + 3, b"".join(out)) if packed else None


def _streams(layer: Layer):
    """A layer of bytes for every stream inside a layer of bytes; streams that follow each
    other are one."""
    raw, at, out, start, end = layer.text, 0, [], 0, 0

    def whole():
        content = b"".join(out)
        if content:
            n = len(content)
            yield Layer(content, _Same(layer.starts[start], n), _Same(layer.ends[end - 1], n), layer.way + "z")

    while m := STREAM.search(raw, at):
        found = _inflate(raw, m.start())
        if found is None:
            at = m.start() + 1
            continue
        if m.start() != end:
            yield from whole()
            out, start = [], m.start()
        out.append(found[1])
        at = end = found[0]
    yield from whole()


def _wide(layer: Layer):
    """A layer of text for every stretch of UTF-16 inside a layer."""
    pattern, empty = (WIDE, b"\0") if isinstance(layer.text, bytes) else (WIDE_TEXT, "\0")
    if empty not in layer.text:
        return
    for m in pattern.finditer(layer.text):
        a, b = m.span()
        chars = m.group()[m.group()[:1] == empty :: 2]
        yield Layer(
            chars.decode("ascii") if isinstance(chars, bytes) else chars,
            layer.starts[a:b:2] if layer.starts else range(a, b, 2),
            layer.ends[a + 1 : b : 2] if layer.ends else range(a + 2, b + 1, 2),
            layer.way + "w",
        )


def _stretches(layer: Layer):
    """``(characters, their places in the layer)`` of every run of base64 characters, and of
    runs on lines that follow each other, joined: lines of one length, and a shorter last."""
    text, joined = layer.text, 0
    for m in BASE64.finditer(text):
        yield m.group(), range(*m.span())
        if m.start() < joined:
            continue
        lines, at, width = [m.span()], m.end(), 0
        while n := NEXT_LINE.match(text, at):
            size = n.end(1) - n.start(1)
            # the first word of a line of prose does not continue a run
            if size > width > 0 or not width and size < 16 and len(m.group()) < 60 and not WHOLE_LINE.match(text, at):
                break
            lines.append(n.span(1))
            at = n.end()
            if size < max(width, 16):
                break
            width = size
        if len(lines) > 1:
            joined = at
        before = LINE_BEFORE.search(text[max(0, m.start() - 256) : m.start()])
        if before and len(before[1]) < 16:
            shift = max(0, m.start() - 256)
            lines.insert(0, (before.start(1) + shift, before.end(1) + shift))
        if len(lines) > 1:
            yield "".join(text[a:b] for a, b in lines), [i for a, b in lines for i in range(a, b)]


def _decoded(layer: Layer, places, first: list[int], last: list[int], raw: bytes, way: str):
    """Bytes of which number i came from the characters ``first[i]`` to ``last[i]``."""
    if not WORTH.search(raw) and not STREAM.search(raw) and not (b"\0" in raw and WIDE.search(raw)):
        return
    starts = [places[i] for i in first]
    ends = [places[i] for i in last]
    starts = [layer.starts[i] for i in starts] if layer.starts else starts
    ends = [layer.ends[i] for i in ends] if layer.ends else [i + 1 for i in ends]
    yield Layer(raw, starts, ends, layer.way + way)


def _unpacked(layer: Layer):
    """Layers of bytes from base64 and hex text."""
    for run, places in _stretches(layer):
        body = run.translate(URL_SAFE)
        for k in range(4):
            part = body[k : len(body) - ((len(body) - k) % 4 == 1)]
            raw = binascii.a2b_base64(part + "=" * (-len(part) % 4))
            n = range(len(raw))
            yield from _decoded(layer, places, [k + 8 * j // 6 for j in n], [k + (8 * j + 7) // 6 for j in n], raw, "b")
        for m in HEX_TEXT.finditer(run):
            for k in (m.start(), m.start() + 1):
                raw = bytes.fromhex(run[k : m.end() - (m.end() - k) % 2])
                n = range(len(raw))
                yield from _decoded(layer, places, [k + 2 * j for j in n], [k + 2 * j + 1 for j in n], raw, "h")


def _unescaped(layer: Layer):
    """Layers with the escapes decoded, as text and, if they hold more than text, as bytes."""
    done = []
    if "%" in layer.text:
        done.append(_unescape(layer, PERCENT, _percent, "u"))
        if done[0] and "+" in layer.text and UNREAD.search(done[0].text):  # bytes of a form: plus is a space
            done.append(_unescape(Layer(layer.text.replace("+", " "), layer.starts, layer.ends, layer.way), PERCENT, _percent, "u"))
    if any(sign in layer.text for sign in ("\\u", "\\x", "\\U", "%u", "&")):
        done.append(_unescape(layer, ESCAPE, _escapes, "x"))
        if done[-1] and SIGN.search(layer.text):
            done.append(_unescape(layer, BYTES, _escapes, "x"))
    for new in filter(None, done):
        yield new
        if UNREAD.search(new.text):
            yield from _streams(_bytes(new))
            if any("\x80" <= c <= "\xff" for c in new.text):
                yield from _streams(_bytes(new, points=True))


def decoded(layer: Layer):
    """Layers one step below ``layer``."""
    if isinstance(layer.text, bytes):
        if WORTH.search(layer.text):
            yield _readable(layer)
        yield from _streams(layer)
        yield from _wide(layer)
        return
    yield from _wide(layer)
    yield from _unescaped(layer)
    yield from _unpacked(layer)


def scan(text: str | None) -> tuple[list, list]:
    """Findings in the text itself, and all findings, both ordered by start and kind."""
    if not text:
        return [], []
    base = matches(text)
    spans = {(k, a, b): "" for k, a, b in base}
    seen = {(text, 0, len(text))}
    work = [Layer(text, None, None, "")]
    while work:
        for layer in decoded(work.pop()):
            place = (layer.text, layer.starts[0], layer.ends[-1])
            if place in seen:
                continue
            seen.add(place)
            for kind, a, b in matches(layer.text) if isinstance(layer.text, str) else ():
                span = (kind, min(layer.starts[a:b]), max(layer.ends[a:b]))
                spans.setdefault(span, layer.way)
            work.append(layer)
    order = lambda s: (s[1], KINDS.index(s[0]), s[2])
    return sorted(base, key=order), [(*s, spans[s]) for s in sorted(spans, key=order)]


def scanned(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``secrets`` (``layer``: the decodings, outermost first:
    u URL, x Unicode or hex escapes and references, b base64, h hex text, w UTF-16,
    z compressed)."""
    prepare(docs.sparkSession)

    def make():
        def work(column):
            base, spans = [], []
            for value in column.to_pylist():
                own, every = scan(value)
                base.append([{"kind": k, "start": a, "end": b} for k, a, b in own])
                spans.append([{"kind": k, "start": a, "end": b, "layer": w} for k, a, b, w in every])
            return [base, spans]

        return work

    return add_columns(docs, text, ADDED, make)


def joined(spans: str):
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def report(done: DataFrame, key: str = "doc_id") -> DataFrame:
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return done.select(
        key,
        *[number(kind) for kind in KINDS],
        F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"),
        joined("secrets").alias("spans"),
    )


def redact(text: str | None, spans, mark: str = "[SECRET]") -> str | None:
    """The text with every stretch that holds a finding replaced by ``mark``."""
    if not text or not spans:
        return text
    out, done = [], 0
    for a, b in sorted((s["start"], s["end"]) for s in spans):
        if a >= done:
            out += [text[done:a], mark]
        done = max(done, b)
    return "".join([*out, text[done:]])


def redacted(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` without the secrets of their texts; all rows and columns stay."""
    prepare(docs.sparkSession)

    def make():
        return lambda column: [[redact(v, [{"start": a, "end": b} for _, a, b, _ in scan(v)[1]], mark) for v in column.to_pylist()]]

    return add_columns(docs, text, f"`{text}` string", make).select(*map(quoted, docs.columns))
