"""JSON arrays of any size, read in splits.

Spark's text reader cuts files into splits at any separator, so arrays are read as the
pieces between commas.  Whether a comma divides two elements depends on what is open
there: a string, and how many brackets.  Two scans find that out.

The first scan gives one short row per split: whether its number of quotes is odd, how
the depth changes, and how many commas and closing brackets there are at each depth, the
depth counted from the start of the split, all of this for both cases, a split that starts
inside a string or outside.  From the rows of the splits before it follows how each split
starts, in file order, and how many elements lie before it.

In the second scan each split cuts its own elements and numbers them.  The first and the
last of a split may go on in the next; these fragments alone are grouped and joined.

An escape is never divided, as no escape holds a comma.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunesmith.session import store

SCAN = (
    "file BIGINT, block BIGINT, odd BOOLEAN, signs BIGINT, first STRING, last STRING, "
    "change ARRAY<BIGINT>, commas ARRAY<MAP<BIGINT, BIGINT>>, closes ARRAY<MAP<BIGINT, BIGINT>>"
)
COMMA, QUOTE, BACKSLASH = 44, 34, 92
_OPENS = np.zeros(256, np.int8)
_OPENS[[91, 123]], _OPENS[[93, 125]] = 1, -1
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 13, 32, 0xEF, 0xBB, 0xBF]] = True  # white space, and the mark at the start of a file


@dataclass(frozen=True)
class Start:
    """How a split starts: inside a string, at which depth, after how many elements."""

    inside: bool
    depth: int
    before: int
    ends_file: bool


def pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """What lies between commas, with a number for the file and the start of the split."""
    return spark.read.option("lineSep", ",").text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )


def _stretches(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
    """The bytes of the pieces of each split in a batch, a comma behind each piece."""
    file, block = (batch.column(i).to_numpy() for i in (0, 1))
    column = batch.column(2).cast(pa.large_string())
    at = np.flatnonzero(np.append(True, (file[1:] != file[:-1]) | (block[1:] != block[:-1])))
    for a, b in zip(at.tolist(), [*at[1:].tolist(), len(file)]):
        part = column.slice(a, b - a)
        offsets = np.frombuffer(part.buffers()[1], np.int64)[part.offset : part.offset + len(part) + 1]
        raw = part.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None and raw.size else np.zeros(0, np.uint8)
        yield (int(file[a]), int(block[a])), np.insert(data, offsets[1:] - offsets[0], COMMA)


def _marks(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte: quotes up to there, modulo 2, and what it opens or closes."""
    quote = data == QUOTE
    slash = data == BACKSLASH
    if slash.any():  # a quote behind an odd number of backslashes is text
        n = np.arange(len(data))
        run = n - np.maximum.accumulate(np.where(slash, -1, n))  # backslashes that end here
        quote[1:] &= run[:-1] % 2 == 0
    return (np.cumsum(quote) & 1).astype(bool), _OPENS[data].astype(np.int64)


def _counts(depths: np.ndarray, into: dict[int, int]) -> None:
    for depth, n in zip(*(x.tolist() for x in np.unique(depths, return_counts=True))):
        into[depth] = into.get(depth, 0) + n


def scan(lines: DataFrame) -> DataFrame:
    """One row per split, in any order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[tuple[int, int], dict] = {}
        for batch in batches:
            for split, data in _stretches(batch) if batch.num_rows else ():
                row = rows.setdefault(split, {"odd": False, "signs": 0, "first": None, "last": None, "change": [0, 0], "commas": [{}, {}], "closes": [{}, {}]})
                within, opens = _marks(data)
                said = np.flatnonzero(~_BLANK[data] & (data != COMMA))
                row["signs"] += len(said)
                if len(said):
                    row["first"] = row["first"] or chr(data[said[0]])
                    row["last"] = chr(data[said[-1]])
                for start in (False, True):
                    outside = within == (start ^ row["odd"])  # after this many quotes in all
                    change = np.where(outside, opens, 0)
                    depth = row["change"][start] + np.cumsum(change)
                    _counts(depth[outside & (data == COMMA)], row["commas"][start])
                    _counts(depth[change < 0], row["closes"][start])
                    row["change"][start] = int(depth[-1])
                row["odd"] ^= bool(within[-1])
        if rows:
            items = [{"file": f, "block": b, **r} for (f, b), r in rows.items()]
            for item in items:
                item["commas"] = [list(m.items()) for m in item["commas"]]
                item["closes"] = [list(m.items()) for m in item["closes"]]
            counts = pa.list_(pa.map_(pa.int64(), pa.int64()))
            kinds = {"file": pa.int64(), "block": pa.int64(), "odd": pa.bool_(), "signs": pa.int64(), "first": pa.string(), "last": pa.string(), "change": pa.list_(pa.int64()), "commas": counts, "closes": counts}
            yield pa.RecordBatch.from_pylist(items, schema=pa.schema(list(kinds.items())))

    return lines.mapInArrow(run, SCAN)


def starts(rows: list, names: dict[int, str]) -> tuple[dict[tuple[int, int], Start], dict[int, int], list[int]]:
    """How each split of an array starts, the elements of each array, and the other files.

    ``rows`` are those of ``scan``.  A file that starts with a bracket has to be one array.
    """
    files: dict[int, list] = {}
    for row in sorted(rows, key=lambda r: (r.file, r.block)):
        files.setdefault(row.file, []).append(row)
    found, sizes, others = {}, {}, []
    for file, splits in files.items():
        inside, depth, tops, before, own = False, 0, 0, 0, {}
        for k, row in enumerate(splits):
            own[file, row.block] = Start(inside, depth, before, k == len(splits) - 1)
            tops += row.closes[inside].get(-depth, 0)
            before += row.commas[inside].get(1 - depth, 0)
            depth += row.change[inside]
            inside ^= row.odd
        signs = [s for row in splits for s in (row.first, row.last) if s]
        if not signs or signs[0] == "[" and sum(row.signs for row in splits) == 2 and signs[-1] == "]" and not before:
            sizes[file] = 0
        elif signs[0] != "[":
            others.append(file)
        elif signs[-1] != "]" or tops > 1 or depth or inside:
            raise ValueError(f"neither a JSON array nor JSON lines: {names[file]}")
        else:
            found.update(own)
            sizes[file] = before + 1
    return found, sizes, others


def cut(lines: DataFrame, known: dict[tuple[int, int], Start]) -> DataFrame:
    """``file``, ``i``, ``block``, ``edge`` and ``text`` of the elements of arrays.

    Elements with ``edge`` may be fragments, to be joined in the order of ``block``.
    """
    shared = lines.sparkSession.sparkContext.broadcast(known)  # one entry per split

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, start, held = None, None, []
        number, within, depth, first = 0, False, 0, True

        def rows(texts: pa.Array, edges: list[bool]) -> pa.RecordBatch:
            n = len(texts)
            return pa.RecordBatch.from_arrays(
                [pa.array([split[0]] * n, pa.int64()), pa.array(range(number, number + n), pa.int64()), pa.array([split[1]] * n, pa.int64()), pa.array(edges, pa.bool_()), texts],
                names=["file", "i", "block", "edge", "text"],
            )

        def end_of_split():
            rest = b"".join(held)
            if start.ends_file:  # the comma that was not there, and the bracket of the array
                rest = rest[:-1].rstrip()[:-1]
            return rows(pa.array([rest.decode()]), [True])

        for batch in batches:
            for now, data in _stretches(batch) if batch.num_rows else ():
                if now not in shared.value:
                    continue
                if now != split:
                    if split:
                        yield end_of_split()
                    split, start, held, first = now, shared.value[now], [], True
                    number, within, depth = start.before, start.inside, start.depth
                    if not split[1]:  # the bracket that opens the array
                        at = int(np.flatnonzero(data == 91)[0])
                        data, depth = data[at + 1 :], 1
                odd, opens = _marks(data)
                outside = odd == within
                levels = depth + np.cumsum(np.where(outside, opens, 0))
                divides = outside & (data == COMMA) & (levels == 1)
                at = np.flatnonzero(divides)
                if len(at):
                    head = b"".join([*held, data[: at[0]].tobytes()])
                    body = data[at[0] + 1 : at[-1] + 1]
                    stops = at[1:] - at[0] - 1
                    keep = np.ones(len(body), bool)
                    keep[stops] = False
                    offsets = np.concatenate([[0, len(head)], len(head) + stops - np.arange(len(stops))]).astype(np.int64)
                    whole = head + body[keep].tobytes()
                    texts = pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(whole)])
                    yield rows(texts.cast(pa.string()), [first, *[False] * (len(at) - 1)])
                    number, held, first = number + len(at), [], False
                    data_left = data[at[-1] + 1 :]
                else:
                    data_left = data
                held.append(data_left.tobytes())
                within ^= bool(odd[-1]) if len(odd) else False
                depth = int(levels[-1]) if len(levels) else depth
        if split:
            yield end_of_split()

    return lines.mapInArrow(run, "file BIGINT, i BIGINT, block BIGINT, edge BOOLEAN, text STRING")


def array_elements(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, dict[int, int], dict[int, str], list[int]]:
    """The elements of all array files, as ``file``, ``i`` and ``text``; the number of
    elements of each, the name of each file, and the files that are no arrays."""
    listed = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("name"))
    names = {r.file: r.name for r in listed.select("name", F.xxhash64("name").alias("file")).collect()}
    lines = pieces(spark, path)
    known, sizes, others = starts(scan(lines).collect(), names)
    found = store(cut(lines, known), "array_elements")
    text = F.array_join(F.array_sort(F.collect_list(F.struct("block", "text")))["text"], "")
    joined = found.where("edge").groupBy("file", "i").agg(text.alias("text"))
    return found.where("NOT edge").select("file", "i", "text").unionByName(joined), sizes, names, others
