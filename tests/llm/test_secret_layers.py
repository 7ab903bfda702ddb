"""Unicode layers of the secret scan, places of decoded bytes, time."""

import base64
import gzip
import random
import time

import pytest

from tunesmith.llm import secrets


WORD = "password=abcdefgh9"


@pytest.mark.parametrize("coded,way", [
    ("".join(f"%u{ord(c):04X}" for c in WORD), "x"),
    ("".join(f"\\U{ord(c):08x}" for c in WORD), "x"),
    ("".join(f"\\u{{{ord(c):x}}}" for c in WORD), "x"),
    ("".join(f"&#X{ord(c):x};" for c in WORD), "x"),
    ("password&equals;abcdefgh9", "x"),
    (base64.b64encode(WORD.encode("utf-16-le")).decode(), "bw"),
    (base64.b64encode(WORD.encode("utf-16-be")).decode(), "bw"),
    (base64.b64encode(gzip.compress(WORD.encode("utf-16-le"))).decode(), "bzw"),
    ("%00".join(WORD) + "%00", "uw"),
    ("\0".join(WORD) + "\0", "w"),
])
def test_unicode_layers_of_secrets(coded, way):
    base, found = secrets.scan(f"é {coded} z")
    kind, start, end, layer = next(f for f in found if f[3])
    assert (kind, layer, start >= 2, end <= 2 + len(coded)) == ("assign", way, True, True)
    assert end - start > len(coded) - 4 and not base


def test_references_without_secrets():
    assert secrets.scan("&unknown; a &amp; b %u12 \\U0011 &#xZZ; \\u{} &equals") == ([], [])


def test_places_of_bytes_of_a_text():
    text = "a\x85é€\U0001f600\udc9f" * 3
    for points in (False, True):
        layer = secrets._bytes(secrets.Layer(text, range(18), range(1, 19), ""), points)
        sizes = [1 if "\udc80" <= c <= "\udcff" or points and c <= "\xff" else len(c.encode()) for c in text]
        want = [i for i, n in enumerate(sizes) for _ in range(n)]
        assert [layer.starts[i] for i in range(len(layer.text))] == want and len(layer.text) == len(want)


def test_binary_text_takes_linear_time():
    def seconds(n):
        coded = base64.b64encode(random.Random(n).randbytes(n)).decode()
        start = time.process_time()
        assert secrets.scan(coded)[1] == []
        return time.process_time() - start

    assert seconds(800_000) < 12 * max(seconds(200_000), 0.5)
