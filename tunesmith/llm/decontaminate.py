"""Benchmark decontamination with a generalised suffix automaton of the test items.

``contamination`` streams the words of every text through an automaton of the normalised
items, tracks the longest matching length at each word and marks every word that lies in
an occurrence of ``window`` consecutive item words (or of a whole shorter item).

The items are the only thing that is sent to the tasks.  They are packed into parts of
at most ``PART_WORDS`` words (a longer item is cut into pieces that overlap by
``window - 1`` words, so no window is lost); each part has its own automaton.
A task holds ``PARTS_HELD`` of them at once; for more parts the texts pass through
further narrow passes, with the result written in between.

Before a word reaches the automaton, its text has to hold a run of item word groups long
enough for a match; this is decided on hashes, for a batch of texts at once.  The test
can only let too much through, never too little, and the automaton decides.

Defined results: a null or empty text has no words and no hits; null or empty items hold
nothing; repeated texts get the same result each; items that share a window are all
listed; without items nothing is contaminated; columns of the texts that have the name
of an added column are replaced; item ids are compared as strings and a null id is left
out of the list, though its windows hit.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunesmith.llm.common import add_columns, prepare
from tunesmith.llm.wordcodes import LETTERS_DIGITS, LOWER, batch_words, gram_codes, words_of
from tunesmith.session import store

WINDOW = 10
#: Words of the items in one automaton: about 50 MB in a worker.
PART_WORDS = 100_000
#: Automata that a task holds at once.
PARTS_HELD = 4
#: Words in the groups that are looked up before the automaton.
GROUP = 5

ADDED = (
    "n_words bigint, n_hit bigint, items array<string>, "
    "hits array<struct<start: bigint, end: bigint, longest: bigint>>"
)


class SuffixAutomaton:
    """Suffix automaton of many word sequences; states are numbers."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]

    def add(self, words: Iterable) -> None:
        last = 0
        for word in words:
            last = self._extend(last, word)

    def _clone(self, state: int, via: int, word, length: int) -> int:
        copy = len(self.next)
        self.next.append(dict(self.next[state]))
        self.length.append(length)
        self.link.append(self.link[state])
        self.link[state] = copy
        while via >= 0 and self.next[via].get(word) == state:
            self.next[via][word] = copy
            via = self.link[via]
        return copy

    def _extend(self, last: int, word) -> int:
        known = self.next[last].get(word)
        if known is not None:  # a former item goes on like this one
            if self.length[known] == self.length[last] + 1:
                return known
            return self._clone(known, last, word, self.length[last] + 1)
        fresh = len(self.next)
        self.next.append({})
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        via = last
        while via >= 0 and word not in self.next[via]:
            self.next[via][word] = fresh
            via = self.link[via]
        if via >= 0:
            other = self.next[via][word]
            if self.length[other] == self.length[via] + 1:
                self.link[fresh] = other
            else:
                self.link[fresh] = self._clone(other, via, word, self.length[via] + 1)
        return fresh

    def step(self, state: int, matched: int, word) -> tuple[int, int]:
        """Longest suffix of the text so far, one word on, that occurs in an item."""
        while state and word not in self.next[state]:
            state = self.link[state]
            matched = self.length[state]
        to = self.next[state].get(word)
        return (0, 0) if to is None else (to, matched + 1)


class ItemIndex:
    """The automaton of one part of the items, and which items its windows belong to."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.automaton = SuffixAutomaton()
        for _, words in items:
            self.automaton.add(words)
        self.full: dict[int, set] = {}  # state of a window -> items
        self.short: dict[int, dict[int, set]] = {}  # state of a short item -> length -> items
        for item, words in items:
            state = matched = 0
            for word in words:
                state, matched = self.automaton.step(state, matched, word)
                if len(words) >= window and matched >= window:
                    self.full.setdefault(self._window_state(state), set()).add(item)
            if len(words) < window:
                self.short.setdefault(state, {}).setdefault(len(words), set()).add(item)
        self._chains: dict[int, list] = {}

    def _window_state(self, state: int) -> int:
        link, length = self.automaton.link, self.automaton.length
        while length[link[state]] >= self.window:
            state = link[state]
        return state

    def _short_suffixes(self, state: int) -> list:
        """Short items that are suffixes of the texts of ``state``: (length, items)."""
        if state not in self._chains:
            found, at = [], state
            while at > 0:
                found += self.short.get(at, {}).items()
                at = self.automaton.link[at]
            self._chains[state] = found
        return self._chains[state]

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int, int]], set]:
        """Hit stretches of ``words`` as (first, end, longest match), and their items."""
        found: list[list[int]] = []
        items: set = set()
        state = matched = 0
        step = self.automaton.step
        for i, word in enumerate(words):
            state, matched = step(state, matched, word)
            reach = 0
            if matched >= self.window:
                reach = matched
                # windows of a piece of an item only: short items are apart
                hit = self.full.get(self._window_state(state))
                if hit:
                    items |= hit
            if self.short and matched:
                for length, whole in self._short_suffixes(state):
                    if length <= matched:
                        items |= whole
                        reach = max(reach, length)
            if reach:
                first = i + 1 - reach
                longest = reach
                while found and found[-1][1] >= first:
                    first = min(first, found[-1][0])
                    longest = max(longest, found[-1][2])
                    found.pop()
                found.append([first, i + 1, longest])
        return [tuple(x) for x in found], items


def item_words(text: str | None) -> list[bytes]:
    data = np.frombuffer((text or "").encode(), dtype=np.uint8)
    _, first, last = words_of(data, 0, len(data), LETTERS_DIGITS)
    low = LOWER[data].tobytes() if len(data) else b""
    return [low[a:b] for a, b in zip(first, last)]


def item_parts(items: DataFrame, item: str, text: str, window: int, part_words: int) -> list[list[tuple]]:
    """Items as parts of bounded size, read one row at a time."""
    parts: list[list[tuple]] = []
    room = 0
    rows = items.where(F.col(text).isNotNull()).select(F.col(item).cast("string").alias("i"), F.col(text).alias("t"))
    for row in rows.distinct().toLocalIterator():
        words = item_words(row.t)
        for at in range(0, max(1, len(words) - window + 1), part_words) if words else ():
            piece = words[at : at + part_words + window - 1]
            if room < len(piece) or not parts:
                parts.append([])
                room = part_words + window
            parts[-1].append((row.i, piece))
            room -= len(piece)
    return parts


def _scanner(part: list[tuple], window: int):
    """Function from an Arrow text array to the added columns, for one part."""
    index = ItemIndex(part, window)
    shortest = min(min(len(words) for _, words in part), window)
    group = min(GROUP, shortest)
    need = shortest - group + 1  # successive groups in the shortest possible match
    groups: list[np.ndarray] = []
    for _, words in part:
        joined = b" ".join(words)
        codes = words_of(np.frombuffer(joined, dtype=np.uint8), 0, len(joined), LETTERS_DIGITS)[0]
        groups.append(gram_codes(codes, group))
    codes = np.unique(np.concatenate(groups))
    bits = max(16, int(64 * len(codes)).bit_length())
    shift = np.uint64(64 - bits)
    seen = np.zeros(1 << bits, dtype=bool)
    seen[(codes >> shift).astype(np.int64)] = True

    def work(column: pa.Array) -> list:
        data, codes, first, last, at = batch_words(column, LETTERS_DIGITS)
        n = len(column)
        n_words = np.diff(at)
        hits: list[list] = [[] for _ in range(n)]
        names: list[set] = [set() for _ in range(n)]
        grams = gram_codes(codes, group)
        inside = seen[(grams >> shift).astype(np.int64)]
        if group > 1 and len(grams):  # not across texts
            for k in range(1, group):
                cross = at[1:-1] - k
                inside[cross[(cross >= 0) & (cross < len(inside))]] = False
        padded = np.concatenate(([False], inside, [False]))
        turns = np.flatnonzero(padded[1:] != padded[:-1])
        begins, ends = turns[::2], turns[1::2]
        text_ends = at[1:]
        for a, b in zip(begins.tolist(), ends.tolist()):
            # single words run on across texts: cut there
            row = int(np.searchsorted(text_ends, a, "right"))
            while a < b:
                stop = min(b, int(text_ends[row])) if group == 1 else b
                if stop - a >= need:
                    upto = stop + group - 1
                    words = [LOWER[data[x:y]].tobytes() for x, y in zip(first[a:upto].tolist(), last[a:upto].tolist())]
                    found, items = index.scan(words)
                    base = a - int(at[row])
                    hits[row] += [(base + x, base + y, z) for x, y, z in found]
                    names[row] |= items
                a = stop
                row += 1
                while a < b and row < n and text_ends[row] <= a:
                    row += 1
        return [n_words, hits, [sorted(x for x in s if x is not None) for s in names]]

    return work


def contamination(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    part_words: int = PART_WORDS,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``items`` and ``hits`` (word ranges)."""
    prepare(docs.sparkSession)
    parts = item_parts(items, item, item_text, window, part_words)
    stages = [parts[i : i + PARTS_HELD] for i in range(0, len(parts), PARTS_HELD)] or [[]]
    done = add_columns(docs, text, ADDED, lambda: _all_parts(stages[0], window))
    for stage in stages[1:]:
        done = _again(store(done, "contamination"), text, stage, window)
    return done


def _again(done: DataFrame, text: str, stage: list, window: int) -> DataFrame:
    """Adds the hits of further parts to those found so far."""
    names = [c.split()[0] for c in ("n_hit", "items", "hits")]
    before = {name: f"__before_{name}" for name in names}
    held = done.withColumnsRenamed(before)
    both = add_columns(held, text, ADDED, lambda: _all_parts(stage, window))
    merge = F.udf(_merged_rows, "array<struct<start: bigint, end: bigint, longest: bigint>>", useArrow=True)
    both = both.withColumn("items", F.array_sort(F.array_union("items", before["items"])))
    both = both.withColumn("hits", merge(F.concat("hits", before["hits"])))
    total = F.aggregate("hits", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return both.withColumn("n_hit", total).drop(*before.values())


def _all_parts(parts: list, window: int):
    scanners = [_scanner(part, window) for part in parts]

    def work(column: pa.Array) -> list:
        n_words = None
        spans: list[list] = [[] for _ in range(len(column))]
        names: list[set] = [set() for _ in range(len(column))]
        for scan in scanners:
            n_words, hits, items = scan(column)
            for i, (h, s) in enumerate(zip(hits, items)):
                spans[i] += h
                names[i].update(s)
        if n_words is None:
            n_words = np.diff(batch_words(column, LETTERS_DIGITS)[4])
        spans = [_merged(s) for s in spans]
        n_hit = [sum(b - a for a, b, _ in s) for s in spans]
        structs = [[{"start": a, "end": b, "longest": c} for a, b, c in s] for s in spans]
        return [n_words, n_hit, [sorted(s) for s in names], structs]

    return work


def _merged_rows(spans):
    merged = _merged([(s["start"], s["end"], s["longest"]) for s in spans])
    return [{"start": a, "end": b, "longest": c} for a, b, c in merged]


def _merged(spans: list) -> list:
    out: list[list[int]] = []
    for a, b, c in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
            out[-1][2] = max(out[-1][2], c)
        else:
            out.append([a, b, c])
    return out


def remove_spans(scanned: DataFrame, text: str = "text", min_length: int = WINDOW, max_coverage: float = 1.0) -> DataFrame:
    """Cuts the hit stretches out of the texts.

    Takes the result of ``contamination``.  Stretches of ``min_length`` words or more are
    removed, from their first word up to the word behind them; a text of which more than
    ``max_coverage`` is hit is dropped as a whole.  Texts without such stretches stay as
    they are.
    """
    kept = scanned.where(
        (F.col("n_words") == 0) | (F.col("n_hit") <= F.lit(max_coverage) * F.col("n_words"))
    ) if max_coverage < 1 else scanned
    kind = kept.schema[text].dataType

    @F.pandas_udf(kind)
    def cut(texts, hits):
        import pandas as pd

        out = []
        for value, spans in zip(texts, hits):
            spans = [] if value is None or spans is None else [s for s in spans if s["end"] - s["start"] >= min_length]
            if spans:
                raw = value.encode()
                _, first, _ = words_of(np.frombuffer(raw, dtype=np.uint8), 0, len(raw), LETTERS_DIGITS)
                keep, done = [], 0
                for s in spans:
                    keep.append(raw[done : first[s["start"]]])
                    done = int(first[s["end"]]) if s["end"] < len(first) else len(raw)
                value = b"".join([*keep, raw[done:]]).decode()
            out.append(value)
        return pd.Series(out, dtype=object)

    return kept.withColumn(text, F.when(F.size("hits") > 0, cut(F.col(text), F.col("hits"))).otherwise(F.col(text)))


def report(scanned: DataFrame, key: str = "doc_id") -> DataFrame:
    """The digest of one row per text."""
    return scanned.select(
        key,
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
