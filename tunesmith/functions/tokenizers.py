"""Outside tokenizers: ids with the place of each token in the text.

A loader returns a function from texts to one ``(ids, spans)`` per text; ``spans`` are the
``(start, end)`` places of the tokens, in code points or in UTF-8 bytes, never going back
(a list, or an array of two columns).  It is called once in every Python worker, so that files are opened there.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from hashlib import md5

import numpy as np

from tunesmith.fixed_values import END, END_ID, FIRST_WORD_ID, PAD, PAD_ID, START, START_ID

Spans = list[tuple[int, int]] | np.ndarray
Encoder = Callable[[list[str]], list[tuple[list[int], Spans]]]
#: Tokens whose hash a worker remembers.
CACHED_TOKENS = 1 << 16


@dataclass(frozen=True)
class OutsideTokenizer:
    """A tokenizer that brings its own ids.

    ``end_id`` closes a turn, ``pad_id`` fills rows on export.  ``unit`` is ``chars`` or
    ``bytes``: what the spans count.
    """

    loader: Callable[[], Encoder]
    end_id: int
    pad_id: int
    unit: str = "chars"

    def __post_init__(self) -> None:
        if self.unit not in ("chars", "bytes"):
            raise ValueError(f"unit: {self.unit}")


def hashing_tokenizer(width: int = 3, size: int = 50_000) -> OutsideTokenizer:
    """Runs of up to ``width`` characters, hashed to ``size`` ids; the chat marks stay whole.

    It needs no vocabulary and knows no borders but the marks and ``<``.
    """
    marks = {PAD: PAD_ID, START: START_ID, END: END_ID}

    def load() -> Encoder:
        pattern = re.compile("|".join(map(re.escape, marks)) + f"|[^<]{{1,{width}}}|<")
        known = dict(marks)

        def number(token: str) -> int:
            if token not in known:
                if len(known) > CACHED_TOKENS:
                    known.clear()
                    known.update(marks)
                known[token] = FIRST_WORD_ID + int(md5(token.encode()).hexdigest()[:8], 16) % size
            return known[token]

        def encode(texts):
            out = []
            for text in texts:
                found = pattern.findall(text)  # every character is in one token
                sizes = np.fromiter(map(len, found), np.int64, len(found))
                ends = np.cumsum(sizes)
                out.append(([number(t) for t in found], np.stack([ends - sizes, ends], axis=1)))
            return out

        return encode

    return OutsideTokenizer(load, END_ID, PAD_ID)


def tokenizer_file(path: str, end_id: int, pad_id: int, marks: tuple[str, ...] = ()) -> OutsideTokenizer:
    """A JSON file of the ``tokenizers`` library; ``marks`` get the ids behind its own.

    ``path`` must be readable on every executor.
    """

    def load() -> Encoder:
        from tokenizers import AddedToken, Tokenizer

        model = Tokenizer.from_file(path)
        model.no_truncation()
        model.no_padding()
        model.add_special_tokens([AddedToken(m, special=True, normalized=False) for m in marks])

        def encode(texts):
            return [(e.ids, e.offsets) for e in model.encode_batch(texts, add_special_tokens=False)]

        return encode

    return OutsideTokenizer(load, end_id, pad_id)


def byte_ranks(ranks_path: str, pattern: str, end_id: int, pad_id: int, marks: dict[str, int]) -> OutsideTokenizer:
    """A ranks file of the ``tiktoken`` library; its tokens are counted in bytes.

    ``marks`` are the special tokens with their ids.  ``ranks_path`` must be readable on
    every executor.
    """

    def load() -> Encoder:
        import base64

        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        model = tiktoken.Encoding("outside", pat_str=pattern, mergeable_ranks=ranks, special_tokens=marks)

        def encode(texts):
            out = []
            for ids in model.encode_batch(texts, allowed_special="all"):
                spans, at = [], 0
                for token in model.decode_tokens_bytes(ids):
                    spans.append((at, at + len(token)))
                    at += len(token)
                out.append((ids, spans))
            return out

        return encode

    return OutsideTokenizer(load, end_id, pad_id, "bytes")
