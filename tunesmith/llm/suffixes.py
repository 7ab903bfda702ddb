"""Substring deduplication with suffix arrays.

Texts are UTF-8 bytes.  A byte goes if it is covered by a string of ``length`` bytes that
also starts earlier: in a document before (order of the key, null keys last, then of a
hash of the text), or further left in the same one.  Strings may overlap, and are
judged on the input, not on what is left of it.

No task can sort the suffixes of a corpus, so they are dealt out by content first.  Every
string of ``length`` bytes has an anchor, the leftmost of its ``GRAM``-byte grams with
the smallest hash; equal strings have equal anchors at equal places.  Strings of a text
that share one anchor are neighbours and make one *snippet*.  Anchors that occur once in
the corpus are dropped by a count on their hashes.  Of equal snippets the first one
represents all (combined before the shuffle); the others are repeated as a whole.

The different snippets of an anchor meet in one task, in corpus order, and are sorted
as suffixes in two stages: suffixes that are smaller than their successor (one byte on)
are sorted directly, the rest follow from one scan over the buckets of first bytes, each
suffix putting its predecessor at the head of that one's bucket.  Adjacent suffixes
with a common prefix of ``length`` bytes are equal strings; all but the first are
repeated.  Orders are exact to ``length`` bytes, which is all that is asked.

An anchor with more than ``most`` different snippets (a short common passage in unlike
surroundings) would be too large for one task.  Its snippets are divided further: each
string becomes a snippet of its own with the string itself as its anchor, so that only
equal strings meet, and their first one is found by an aggregate.

Only hashes and places of repeated anchors, and each different repeated snippet once,
are shuffled, besides the texts themselves, which are joined twice: with the snippets to
sort, and with the spans that go.

Defined results: null texts count as empty; texts shorter than ``length`` stay whole;
rows that are equal in key and text are one document, given more than once, and do not
remove each other; rows with one key and different texts are ordered by their hash; an
empty table gives an empty result; further columns stay, except that those with the name
of an added one (in any case) are replaced.  Texts are read in pieces of ``PIECE``
bytes, so arrays are bounded for very long ones, too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunesmith.llm.common import add_columns, kept, output_names, prepare, quoted
from tunesmith.llm.wordcodes import BYTE_CODES, mix, utf8_parts

LENGTH = 100
GRAM = 32
#: Different snippets of one anchor that one task sorts at once.
MOST = 6000
#: Bytes that are hashed at once, and that are sorted at once.
PIECE = 1 << 20
CHUNK = 1 << 20
#: Between snippets; no UTF-8 text has this byte.
BORDER = 0xFF
_FACTOR = 0x9E3779B97F4A7C15


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hashes of all ``gram``-byte grams, by doubling their length (``gram``: a power of two)."""
    codes, width = BYTE_CODES[data], 1
    while width < gram:
        factor = np.uint64(pow(_FACTOR, width, 1 << 64) | 1)
        codes = mix(codes[:-width] * factor + codes[width:]) if len(codes) > width else codes[:0]
        width *= 2
    return codes


def snippets(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, snippet hash, first and last string of the snippets of one text."""
    found = []
    for start in range(0, max(len(data) - length + 1, 0), PIECE):
        piece = data[start : start + PIECE + length - 1]
        hashes = gram_hashes(piece, gram)
        low = hashes >> np.uint64(32) << np.uint64(32) | np.arange(len(hashes), dtype=np.uint64)
        width, span = 1, length - gram + 1
        while width * 2 <= span:
            low, width = np.minimum(low[:-width], low[width:]), width * 2
        if width < span:
            low = np.minimum(low[: len(low) - (span - width)], low[span - width :])
        at = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        last = np.append(first[1:], len(at)) - 1
        anchor = at[first]
        up = np.cumprod(np.append(np.uint64(1), np.full(len(piece), np.uint64(_FACTOR))), dtype=np.uint64)
        down = np.cumprod(np.append(np.uint64(1), np.full(len(piece), np.uint64(pow(_FACTOR, -1, 1 << 64)))), dtype=np.uint64)
        sums = np.append(np.uint64(0), np.cumsum(BYTE_CODES[piece] * up[:-1], dtype=np.uint64))
        own = (sums[last + length] - sums[first]) * down[first]
        own = mix(own + ((anchor - first) * 256 + (last - first)).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        found.append((hashes[anchor], own, first + start, last + start))
    if not found:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none.astype(np.uint64), none, none
    return tuple(np.concatenate(x) for x in zip(*found))


def anchored(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """``key``, ``id`` and the snippets of every document (``key``, ``id``, ``text``).

    A snippet is ``anchor``, ``own`` (hashes of its anchor and of itself) and ``place``:
    256 times its first byte plus the number of its strings less one.
    """

    def make():
        def work(column):
            data, starts, ends = utf8_parts(column)
            parts = [snippets(data[a:b], length, gram) for a, b in zip(starts, ends)]
            at = np.cumsum([0, *(len(p[0]) for p in parts)]).astype(np.int32)
            whole = [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 4
            fields = [whole[0].view(np.int64), whole[1].view(np.int64), whole[2] * 256 + whole[3] - whole[2]]
            items = pa.StructArray.from_arrays([pa.array(f, pa.int64()) for f in fields], ["anchor", "own", "place"])
            return [pa.ListArray.from_arrays(pa.array(at, pa.int32()), items)]

        return work

    return add_columns(docs, "text", "snippets array<struct<anchor:bigint,own:bigint,place:bigint>>", make)


def firsts_of(found: DataFrame) -> DataFrame:
    """The first occurrence of each different snippet."""
    order = F.struct(F.col("key").isNull().alias("none"), "key", "id", "place")
    return found.groupBy("anchor", "own").agg(F.min(order).alias("first"))


def repeats_of(found: DataFrame, firsts: DataFrame, length: int) -> DataFrame:
    """Spans of the snippets that are not the first of their kind."""
    both = found.join(firsts.select("anchor", "own", "first"), ["anchor", "own"])
    both = both.where(~(F.col("first.key").eqNullSafe(F.col("key")) & (F.col("first.id") == F.col("id")) & (F.col("first.place") == F.col("place"))))
    return both.select("key", "id", *_span(length))


def _span(length: int) -> list:
    start, more = F.expr("shiftright(place, 8)"), F.expr("place & 255")
    return [start.alias("start"), (start + more + length).alias("end")]


def snippet_bytes(docs: DataFrame, places: DataFrame, length: int, each: bool = False) -> DataFrame:
    """``anchor``, ``own``, ``key``, ``id``, ``place`` and ``bytes`` of the snippets at ``places``.

    With ``each`` every string of a snippet is one of its own, hashed by itself, and no
    bytes are given.
    """
    wanted = places.groupBy("id", "key").agg(F.collect_list(F.struct("anchor", "own", "place")).alias("wanted"))
    rows = docs.join(wanted.withColumnRenamed("key", "of"), ["id"]).where(F.col("key").eqNullSafe(F.col("of")))
    source = F.struct("text", "wanted").alias("source")

    def make():
        def work(column):
            out = []
            for text, wanted in zip(column.field("text").to_pylist(), column.field("wanted").to_pylist()):
                raw, mine = text.encode(), []
                if each:
                    at = np.unique(np.concatenate([np.arange(w["place"] >> 8, (w["place"] >> 8) + (w["place"] & 255) + 1) for w in wanted]))
                    data = np.frombuffer(raw, np.uint8)
                    a, b = (_string_hashes(data, at, length, k) for k in (0, 1))
                    mine = [(x, y, p << 8, None) for x, y, p in zip(a.tolist(), b.tolist(), at.tolist())]
                else:
                    for w in wanted:
                        p = w["place"]
                        mine.append((w["anchor"], w["own"], p, raw[p >> 8 : (p >> 8) + (p & 255) + length]))
                out.append([dict(zip(("anchor", "own", "place", "bytes"), m)) for m in mine])
            return [out]

        return work

    kind = "cut array<struct<anchor:bigint,own:bigint,place:bigint,bytes:binary>>"
    cut = add_columns(rows.select("key", "id", source), "source", kind, make)
    return cut.select("key", "id", F.explode("cut").alias("cut")).select("key", "id", "cut.*")


def _string_hashes(data: np.ndarray, at: np.ndarray, length: int, seed: int) -> np.ndarray:
    total = np.full(len(at), np.uint64(seed + 1))
    for k in range(length):
        total = (total ^ BYTE_CODES[data[at + k]]) * np.uint64(_FACTOR + 2 * seed)
        total ^= total >> np.uint64(29)
    return mix(total).view(np.int64)


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of all suffixes of ``text``, in the order of their first ``depth`` bytes."""
    n = len(text)
    step = np.sign(np.append(text[1:].astype(np.int16), -1) - text)
    change = np.minimum.accumulate(np.where(step != 0, np.arange(n), n - 1)[::-1])[::-1]
    smaller = step[change] > 0  # than the suffix one byte on
    # stage one: sort these directly
    short = np.flatnonzero(smaller)
    padded = np.append(text, np.zeros(depth, np.uint8))
    keys = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, depth)[short]).view(f"S{depth}").ravel()
    short = short[np.argsort(keys, kind="stable")]
    # stage two: induce the others, bucket by bucket; in a bucket they precede the sorted ones
    size = np.bincount(text, minlength=256)
    head = np.append(0, np.cumsum(size)[:-1])
    tail = head + size
    n_short = np.bincount(text[short], minlength=256)
    order = np.empty(n, np.int64)
    order[np.arange(len(short)) + np.repeat(tail - np.cumsum(n_short), n_short)] = short

    def induce(scanned):
        before = scanned[scanned > 0] - 1
        before = before[~smaller[before]]
        of = text[before]
        by = np.argsort(of, kind="stable")
        before, of = before[by], of[by]
        count = np.bincount(of, minlength=256)
        order[head[of] + np.arange(len(of)) - (np.cumsum(count) - count)[of]] = before
        head[:] += count

    if n:
        induce(np.array([n]))  # the empty suffix comes first
    for byte in np.flatnonzero(size):
        done = tail[byte] - size[byte]
        while done < head[byte]:  # runs of one byte fill their own bucket
            done, scan = head[byte], order[done : head[byte]].copy()
            induce(scan)
        induce(order[tail[byte] - n_short[byte] : tail[byte]])
    return order


def repeated_strings(pieces: list[bytes], length: int) -> list[tuple[int, int, int]]:
    """``(piece, start, end)``: runs of strings that start earlier, in ``pieces`` as one text."""
    text = np.frombuffer(b"".join(p + bytes([BORDER]) for p in pieces), np.uint8)
    sizes = np.array([len(p) for p in pieces])
    starts = np.cumsum(np.append(0, sizes[:-1] + 1))
    whole = np.zeros(len(text) + 1, np.int64)  # positions at which a whole string starts
    np.add.at(whole, starts, 1)
    np.add.at(whole, starts + sizes - length + 1, -1)
    whole = np.cumsum(whole)[:-1] > 0
    order = suffix_order(text, length)
    order = order[whole[order]]
    strings = np.lib.stride_tricks.sliding_window_view(text, length)
    common = np.zeros(len(order), np.int64)  # with the suffix before
    for a in range(1, len(order), 1 << 16):
        b = min(a + (1 << 16), len(order))
        unlike = strings[order[a:b]] != strings[order[a - 1 : b - 1]]
        common[a:b] = np.where(unlike.any(axis=1), unlike.argmax(axis=1), length)
    group = np.cumsum(common < length) - 1
    if not len(group):
        return []
    first = np.minimum.reduceat(order, np.flatnonzero(common < length))
    again = np.sort(order[order != first[group]])
    if not len(again):
        return []
    of = np.searchsorted(starts, again, "right") - 1
    begin = np.flatnonzero(np.append(True, (np.diff(again) > 1) | (np.diff(of) > 0)))
    end = np.append(begin[1:], len(again)) - 1
    return [(int(i), int(a), int(b)) for i, a, b in zip(of[begin], again[begin] - starts[of[begin]], again[end] - starts[of[end]] + length)]


def sorted_repeats(cut: DataFrame, length: int) -> DataFrame:
    """Spans of repeated strings in the first occurrences of different snippets."""
    none = F.col("key").isNull()
    dealt = cut.repartition("anchor").sortWithinPartitions("anchor", none, "key", "id", "place")
    rows = dealt.select("anchor", "key", "id", "place", "bytes")
    schema = rows.select("key", "id", F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("end")).schema

    def solve(rows: list[pa.RecordBatch], names) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows).combine_chunks()
        found = repeated_strings(table.column("bytes").to_pylist(), length)
        of = np.array([f[0] for f in found], np.int64)
        base = (np.array(table.column("place"), np.int64) >> 8)[of]
        inside = np.array([f[1:] for f in found], np.int64).reshape(-1, 2)
        key, id_ = (table.column(c).combine_chunks().take(pa.array(of)) for c in ("key", "id"))
        return pa.RecordBatch.from_arrays([key, id_, *(pa.array(base + inside[:, i]) for i in (0, 1))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, held, size = ["key", "id", "start", "end"], [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            anchors = batch.column(0).to_numpy(zero_copy_only=False)
            if size >= CHUNK:  # solve what is whole: all before the last anchor
                last = held[-1].column(0)[-1].as_py()
                n = int(np.searchsorted(anchors != last, True)) if (anchors != last).any() else batch.num_rows
                held.append(batch.slice(0, n))
                batch = batch.slice(n)
                if batch.num_rows:
                    yield solve(held, names)
                    held, size = [], 0
            if batch.num_rows:
                held.append(batch)
                size += batch.column(4).nbytes
        if held:
            yield solve(held, names)

    return rows.mapInArrow(run, schema)


def removed_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most: int = MOST) -> DataFrame:
    """``key``, ``id`` and ``spans``: byte ranges of ``docs`` (``key``, ``id``, ``text``) that go."""
    table = kept(anchored(docs, length, gram).drop("text"), "suffix_snippets")
    one = table.select("key", "id", F.explode("snippets").alias("s")).select("key", "id", "s.anchor", "s.own", "s.place")
    shared = one.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    found = kept(one.join(shared, "anchor"), "suffix_repeats")
    firsts = kept(firsts_of(found), "suffix_firsts")
    # equal strings lie at equal places of their snippets, so one snippet alone repeats nothing
    sizes = firsts.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    places = firsts.join(sizes, "anchor").select("anchor", "own", "first.key", "first.id", "first.place", "n")
    places = kept(places, "suffix_places")
    few = F.col("n") <= most
    spans = kept(sorted_repeats(snippet_bytes(docs, places.where(few), length), length), "suffix_sorted")
    spans = spans.unionByName(repeats_of(found, firsts, length))
    if not places.where(~few).isEmpty():
        single = kept(snippet_bytes(docs, places.where(~few), length, each=True).drop("bytes"), "suffix_strings")
        spans = spans.unionByName(repeats_of(single, firsts_of(single), length))
    spans = kept(spans, "suffix_spans")
    return spans.groupBy("id", "key").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def identified(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``row`` (all columns), ``key``, ``id`` and ``text``; null texts are empty."""
    whole = F.coalesce(F.col(quoted(text)), F.lit(""))
    key_ = F.col(quoted(key))
    return docs.select(F.struct("*").alias("row"), key_.alias("key"), F.xxhash64(key_, whole).alias("id"), whole.alias("text"))


def deduplicate(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, most: int = MOST
) -> DataFrame:
    """``docs`` with ``kept`` (the bytes that stay, which may cut a character in two),
    ``n_bytes``, ``n_removed`` and ``removed`` (maximal byte ranges ``start``, ``end``)."""
    if gram & (gram - 1) or not gram <= length <= gram + 255:
        raise ValueError("gram must be a power of two, at most length, and at least length - 255")
    prepare(docs.sparkSession)
    rows = identified(docs, key, text)
    spans = removed_spans(rows.select("key", "id", "text"), length, gram, most)
    joined = rows.join(spans.withColumnRenamed("key", "of").withColumnRenamed("id", "of_id"), (F.col("id") == F.col("of_id")) & F.col("key").eqNullSafe(F.col("of")), "left")

    def make():
        def work(column):
            kept, n_bytes, n_removed, removed = [], [], [], []
            for text_, spans_ in zip(column.field("text").to_pylist(), column.field("spans").to_pylist()):
                raw = text_.encode()
                runs: list[list[int]] = []
                for a, b in sorted((s["start"], s["end"]) for s in spans_ or []):
                    if runs and a <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], b)
                    else:
                        runs.append([a, b])
                edges = [0, *(x for r in runs for x in r), len(raw)]
                kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
                n_bytes.append(len(raw))
                n_removed.append(sum(b - a for a, b in runs))
                removed.append([{"start": a, "end": b} for a, b in runs])
            return [kept, n_bytes, n_removed, removed]

        return work

    added = "kept binary, n_bytes bigint, n_removed bigint, removed array<struct<start:bigint,end:bigint>>"
    done = add_columns(joined.select("row", F.struct("text", "spans").alias("source")), "source", added, make)
    return output_names(done, docs, ["kept", "n_bytes", "n_removed", "removed"])
