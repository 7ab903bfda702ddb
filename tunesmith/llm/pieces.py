"""SentencePiece encoding and decoding with a shared-prefix Viterbi.

The words of a batch of texts, marked with the word sign, are taken once each and sorted;
sorted words are the depth-first order of their trie.  A walk over them keeps the forward
table of the current path: for every prefix its best segmentation, as the score and the
last piece.  A word goes on from the table of the prefix that it shares with the word
before it, so the forward values of common prefixes are computed once.  Texts are put
together from the ids of their words; workers remember words between batches.

* ``unigram`` models: the forward value is the highest sum of piece scores.
* ``bpe`` models: merging does not maximise a sum, so plain Viterbi would give other ids
  than the model.  Here the forward value of a prefix is the last piece of its merged
  form: of the pieces that end there, the one that the merge rule leaves standing behind
  the last piece of the shorter prefix.  There is exactly one, so the same walk gives the
  ids of the merges without doing them.

Characters that no piece covers become byte pieces, or the unknown piece.  Models are
read on the driver with the sentencepiece library and sent to the tasks as plain lists
(about 32,000 pieces); nothing is trained.

Defined results: null texts give null ids and zero tokens, empty texts no ids; texts are
encoded whole; repeated texts get the same ids; decoding the ids of a text gives the text
again unless it contains the word sign itself (which stands for a blank) or, in models
without byte pieces, uncovered characters: ``round_trip`` tells.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tunesmith.llm.common import add_columns, prepare

MARK = "▁"
#: Words that a worker remembers between batches.
REMEMBERED = 400_000


@dataclass
class Model:
    """Pieces of a SentencePiece model."""

    kind: str  # "bpe" or "unigram"
    pieces: list[str]
    scores: list[float]
    special: set[int] = field(default_factory=set)  # control, unknown and byte pieces
    bytes_: list[int] = field(default_factory=list)  # id of each byte, or empty
    unknown: int = 0
    dummy_prefix: bool = True


def load_model(path: str) -> Model:
    """Reads a model file.  The kind is told by the scores: merge ranks are whole numbers."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    n = m.get_piece_size()
    pieces, scores = [m.id_to_piece(i) for i in range(n)], [m.get_score(i) for i in range(n)]
    special = {i for i in range(n) if m.is_byte(i) or m.is_control(i) or m.is_unknown(i)}
    by_byte = {pieces[i]: i for i in range(n) if m.is_byte(i)}
    bytes_ = [by_byte[f"<0x{b:02X}>"] for b in range(256)] if len(by_byte) == 256 else []
    ranks = all(float(s).is_integer() for i, s in enumerate(scores) if i not in special)
    dummy = m.encode("a", out_type=str) != ["a"]
    return Model("bpe" if ranks else "unigram", pieces, scores, special, bytes_, m.unk_id(), dummy)


class Encoder:
    """Encodes words with one model; kept by a worker."""

    def __init__(self, model: Model):
        self.model = model
        self.ids = {p: i for i, p in enumerate(model.pieces) if i not in model.special}
        #: every ending of a piece (tells how far back pieces that end at a place may start),
        #: with whether it is a piece; for merges: one that merging its characters gives
        self.endings: dict[str, bool] = dict.fromkeys((p[i:] for p in self.ids for i in range(len(p))), False)
        for p in self.ids:
            self.endings[p] = model.kind != "bpe" or len(self._merge(p)) == 1
        self.known: dict[str, list[int]] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        barrier = "" if "\n" in self.ids or any("\n" in p for p in self.ids) else "\n"
        self.words = re.compile(rf"{MARK}*[^{MARK}{barrier}]+|{MARK}+|{barrier}" if barrier else rf"{MARK}*[^{MARK}]+|{MARK}+")
        least = min((model.scores[i] for i in self.ids.values()), default=0.0)
        self.missing = least - 10.0  # score of a character that no piece covers
        self.out = [p.replace(MARK, " ").encode() for p in model.pieces]
        for b, i in enumerate(model.bytes_):
            self.out[i] = bytes([b])
        for i in model.special - set(model.bytes_):
            self.out[i] = b""
        self.out[model.unknown] = " ⁇ ".encode()

    def marked(self, text: str) -> str:
        return (MARK if self.model.dummy_prefix and text else "") + text.replace(" ", MARK)

    # --- the walk over sorted words ---------------------------------------------------

    def learn(self, words: list[str]) -> None:
        """Ids of words not known yet."""
        extend = self._extend_merged if self.model.kind == "bpe" else self._extend_scored
        before = ""
        table: list[tuple] = [(0.0, 0, "")]  # per prefix: score, start and text of its last piece
        for word in sorted(words):
            same = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                same += 1
            del table[same + 1 :]
            extend(word, table)
            self.known[word] = self._ids(word, table)
            before = word

    def _extend_scored(self, word: str, table: list) -> None:
        for end in range(len(table), len(word) + 1):
            best = (table[end - 1][0] + self.missing, end - 1, word[end - 1])
            start = end - 1
            while start >= 0 and (whole := self.endings.get(piece := word[start:end])) is not None:
                if whole:
                    score = table[start][0] + self.model.scores[self.ids[piece]]
                    if score > best[0]:
                        best = (score, start, piece)
                start -= 1
            table.append(best)

    def _extend_merged(self, word: str, table: list) -> None:
        endings, pairs = self.endings, self.pairs
        for end in range(len(table), len(word) + 1):
            found = (0.0, end - 1, word[end - 1])
            start = end - 2
            while start >= 0 and (whole := endings.get(piece := word[start:end])) is not None:
                if whole:
                    left = table[start][2]
                    ok = pairs.get((left, piece)) if start else True
                    if self._next_to(left, piece) if ok is None else ok:
                        found = (0.0, start, piece)
                        break  # no other piece stands here
                start -= 1
            table.append(found)

    def _next_to(self, left: str, right: str) -> bool:
        """Whether merging leaves two pieces as they are when they stand side by side."""
        ok = self.pairs[left, right] = self._merge(left + right) == [left, right]
        return ok

    def _merge(self, text: str) -> list[str]:
        """Merges the best-scored neighbours until none is a piece (for short texts)."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                piece = self.ids.get(parts[i] + parts[i + 1])
                if piece is not None and (best is None or self.model.scores[piece] > best):
                    best, at = self.model.scores[piece], i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _ids(self, word: str, table: list) -> list[int]:
        out: list[int] = []
        end = len(word)
        while end:
            _, start, piece = table[end]
            i = self.ids.get(piece)
            if i is not None:
                out.append(i)
            elif self.model.bytes_:
                out += [self.model.bytes_[b] for b in reversed(piece.encode())]
            elif not out or out[-1] != self.model.unknown:
                out.append(self.model.unknown)
            end = start
        return out[::-1]

    # --- texts ------------------------------------------------------------------------

    def encode(self, texts: list[str | None]) -> list[list[int] | None]:
        split = [self.words.findall(self.marked(t)) if t is not None else None for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        if len(self.pairs) > REMEMBERED:
            self.pairs.clear()
        self.learn(list(set().union(*filter(None, split)) - self.known.keys()))
        look = self.known.__getitem__
        return [None if words is None else list(chain.from_iterable(map(look, words))) for words in split]

    def decode(self, ids) -> str:
        text = b"".join(map(self.out.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.model.dummy_prefix and text.startswith(" ") else text


def encoded(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``ids``, ``n_tokens`` and ``round_trip``."""
    prepare(docs.sparkSession)

    def make():
        encoder = Encoder(model)

        def work(column):
            texts = column.to_pylist()
            ids = encoder.encode(texts)
            ok = [i is not None and encoder.decode(i) == t for i, t in zip(ids, texts)]
            flat = np.fromiter(chain.from_iterable(filter(None, ids)), dtype=np.int32)
            ends = np.zeros(len(ids) + 1, np.int32)
            np.cumsum([len(i or ()) for i in ids], out=ends[1:])
            valid = pa.array([i is None for i in ids])
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat), mask=valid)
            return [lists, [len(i or ()) for i in ids], ok]

        return work

    return add_columns(docs, text, "ids array<int>, n_tokens bigint, round_trip boolean", make)


def decoded(rows: DataFrame, model: Model, ids: str = "ids") -> DataFrame:
    """``rows`` with ``decoded``, the text of their ids."""
    prepare(rows.sparkSession)

    def make():
        encoder = Encoder(model)
        return lambda column: [[None if i is None else encoder.decode(i) for i in column.to_pylist()]]

    return add_columns(rows, ids, "decoded string", make)
