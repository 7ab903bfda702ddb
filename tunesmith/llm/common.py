"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunesmith.session import store

#: Rows per Arrow batch.  Texts are processed whole, so a batch is kept to a few hundred
#: of them: at 3 kB each that is about a megabyte, and hundred of 1 MB still fit a worker.
BATCH_ROWS = 256


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings that bound the memory of a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def kept(df: DataFrame, label: str) -> DataFrame:
    """``store``, after which Spark drops the shuffle files of the job that wrote it.

    The stored table is read from then on, so nothing needs them again; otherwise they
    stay until the driver collects garbage.  The setting is put back.
    """
    conf, name = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name, None)
    conf.set(name, "true")
    try:
        return store(df, label)
    finally:
        conf.unset(name) if before is None else conf.set(name, before)


def fold(key: str, n: int):
    """crc32 of a key written as text, modulo ``n``; null for a null key."""
    return F.pmod(F.crc32(F.col(key).cast("string")), F.lit(n))


def temp(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have."""
    name = f"__{stem}"
    while name.lower() in {c.lower() for c in df.columns}:
        name = f"_{name}"
    return name


def arrow_type(kind: T.DataType) -> pa.DataType:
    """Arrow type of the Spark types that operators add."""
    if isinstance(kind, T.ArrayType):
        return pa.list_(arrow_type(kind.elementType))
    if isinstance(kind, T.StructType):
        return pa.struct([pa.field(f.name, arrow_type(f.dataType)) for f in kind.fields])
    return {
        T.StringType(): pa.string(),
        T.LongType(): pa.int64(),
        T.IntegerType(): pa.int32(),
        T.DoubleType(): pa.float64(),
        T.FloatType(): pa.float32(),
        T.BooleanType(): pa.bool_(),
        T.BinaryType(): pa.binary(),
    }[kind]


def add_columns(df: DataFrame, text: str, added: str, make) -> DataFrame:
    """``df`` with the columns of the DDL string ``added``, from batches of ``text``.

    ``make`` is called once per task and returns a function from an Arrow string array
    to a list of arrays, one for each added column.  Columns of ``df`` that have the
    name of an added one are replaced.  Narrow: no shuffle, one pass over ``df``.
    """
    new = T._parse_datatype_string(added)
    gone = {f.name.lower() for f in new.fields}
    kept = [c for c in df.columns if c.lower() not in gone]
    source = temp(df, "text")
    rows = df.select(F.col(quoted(text)).alias(source), *[F.col(quoted(c)) for c in kept])
    # plain names on the way through Python: those of the input may hold dots
    plain = [f"c{i}" for i in range(len(kept) + len(new.fields))]
    rows = rows.toDF(source, *plain[: len(kept)])
    fields = [T.StructField(n, f.dataType) for n, f in zip(plain, [*rows.schema.fields[1:], *new.fields])]
    kinds = [arrow_type(f.dataType) for f in new.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            made = [pa.array(v, type=k) if not isinstance(v, pa.Array) else v.cast(k)
                    for v, k in zip(work(batch.column(0)), kinds)]
            yield pa.RecordBatch.from_arrays(batch.columns[1:] + made, names=plain)

    return rows.mapInArrow(run, T.StructType(fields)).toDF(*kept, *[f.name for f in new.fields])


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def output_names(done: DataFrame, docs: DataFrame, added: list[str]) -> DataFrame:
    """The columns of ``docs``, packed in ``row``, and the ``added`` ones, which replace
    columns of their names in any case."""
    gone = {a.lower() for a in added}
    kept = [F.col("row").getField(c).alias(c) for c in docs.columns if c.lower() not in gone]
    return done.select(*kept, *added)


def bounded_sample(marks: DataFrame, docs: DataFrame, text: str, per_label: int) -> DataFrame:
    """Up to ``per_label`` distinct texts of each label, as ``(label, text)``.

    ``marks`` holds ``label`` and ``h``, the ``xxhash64`` of a labelled text.  The choice
    is the order of ``h``, so it does not depend on layout, repeated texts count once,
    and only hashes are ranked and shuffled.  The result has at most ``per_label`` rows
    per label however many rows there are, which also bounds what is broadcast.
    """
    ranked = marks.where("label IS NOT NULL AND h IS NOT NULL").distinct()
    for part in ("label, pmod(h, 61)", "label"):  # in 61 parts first, so that no task ranks a whole label
        ranked = ranked.withColumn("rank", F.expr(f"row_number() OVER (PARTITION BY {part} ORDER BY h)"))
        ranked = ranked.where(F.col("rank") <= per_label).drop("rank")
    chosen = ranked.select("label", "h")
    texts = docs.where(F.col(text).isNotNull()).select(F.col(text).alias("text"), F.xxhash64(text).alias("h"))
    return texts.join(F.broadcast(chosen), "h").dropDuplicates(["label", "h"]).select("label", "text")


def text_hash(text: str):
    """``xxhash64`` of a text, null for a null one."""
    return F.when(F.col(text).isNotNull(), F.xxhash64(text))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of ``(a, b)`` long pairs: one ``(node, root)`` row per node.

    ``root`` is the smallest node of the component.  Alternating large-star and
    small-star rounds (Kiveris et al. 2014): every round is two aggregates and two joins
    on node ids, each node's neighbours are only ever reduced to a minimum, and the
    number of rounds grows with the logarithm of the component size.  Each round is
    written to the shared folder, so no lineage grows and a lost executor costs one
    round.
    """
    current = store(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        label,
    )
    state = _state(current)
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low"))
        low = low.select("u", F.least("u", "low").alias("low"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        # every node also keeps a link to its own minimum
        large = large.unionByName(low.where("low < u").select("u", F.col("low").alias("v"))).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(least, "u").where("v > low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        small = small.unionByName(least.select("u", F.col("low").alias("v"))).distinct()
        current = store(small, label)
        before, state = state, _state(current)
        if state == before:
            break
    roots = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)),
        F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)),
        F.coalesce(F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 31))), F.lit(0)),
    ).first()
    return tuple(row)


def whole_groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, list[pa.RecordBatch]]]:
    """Groups of sorted Arrow batches, each once and whole: ``(key, pieces)``.

    The first ``n_keys`` columns are the key; rows of a key are adjacent.
    """
    held_key, held = None, []
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        keys = list(zip(*(batch.column(i).to_pylist() for i in range(n_keys))))
        start = 0
        while start < n:
            end = start + 1
            while end < n and keys[end] == keys[start]:
                end += 1
            if keys[start] != held_key and held:
                yield held_key, held
                held = []
            held_key = keys[start]
            held.append(batch.slice(start, end - start))
            start = end
    if held:
        yield held_key, held


def block_pairs(df: DataFrame, group: str, size: str, node: str, block: int, own_pairs: bool = False) -> DataFrame:
    """Rows copied to the pairs of blocks in which they have to be compared.

    A group of up to ``block`` rows is one block.  A larger one is cut by a hash of the
    node into blocks of about that size, and each pair of blocks is a task of its own,
    so that no group has to fit into one task.  ``own_pairs`` makes the pair of a block
    with itself a task, too.  Adds ``own``, ``bi`` and ``bj``.
    """
    blocks = F.ceil(F.col(size) / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64(F.lit("block"), F.col(node)), blocks).cast("int")
    cut = df.withColumn("blocks", blocks).withColumn("own", own)
    pairs = F.when(F.col("blocks") == 1, F.array(F.struct(F.lit(0).alias("bi"), F.lit(0).alias("bj")))).otherwise(
        F.transform(
            F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.lit(own_pairs) | (j != F.col("own"))),
            lambda j: F.struct(F.least(F.col("own"), j).alias("bi"), F.greatest(F.col("own"), j).alias("bj")),
        )
    )
    return cut.withColumn("pair", F.explode(pairs)).select(
        "*", F.col("pair.bi").alias("bi"), F.col("pair.bj").alias("bj")
    ).drop("pair", "blocks")


def fresh(stem: str) -> str:
    return f"{stem}_{uuid.uuid4().hex}"
