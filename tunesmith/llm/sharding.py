"""Sharding by extendible hashing, in DataFrame operations only.

Rows are hashed to 60 bits.  A shard is a prefix of these bits; it starts at depth 0 and
is split on one more bit as long as its rows exceed the byte limit, so only oversized
shards get deeper.  The directory has one entry for every prefix of the depth of the
deepest shard of a round, and names the shard that prefix belongs to; a row finds its
shard by an equi-join of its own leading bits with the directory.

Splitting works on sums.  A round sums the bytes of the rows of oversized shards over
their next ``STEP`` bits (combined before the shuffle), rolls the sums up to each depth,
and takes for every prefix the smallest depth at which the sum fits.  Prefixes that do
not fit at the deepest of these depths go into the next round.  Only 16 bytes per row are
stored and shuffled; texts are read once for their hash and length.

The hash covers the key and the content, so a key that holds a third of all rows is
spread.  Rows that are equal in both are numbered, on the path of the prefixes that no
bit can split, and each gets bits of its own number behind the common ones.

Defined results: a shard over the limit holds a single row that is itself larger, and is
marked ``oversized``; null keys and null contents are hashed as such, a null content has
no bytes; an empty table gives no shards; further columns
stay, except that those with the name of an added one (in any case) are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunesmith.llm.common import quoted
from tunesmith.session import store

BITS = 60
#: Bits that one round looks at.
STEP = 10
LIMIT_BYTES = 8 << 20


def content_hash(*columns: str) -> F.Column:
    """The first 60 bits of an md5 over columns written as text."""
    text = F.concat_ws("|", *[F.coalesce(F.col(quoted(c)).cast("string"), F.lit("~")) for c in columns])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def directory(keys: DataFrame, limit: int = LIMIT_BYTES, step: int = STEP) -> DataFrame:
    """The shards of stored ``(h, bytes)`` rows.

    One row per directory entry of its round: ``round``, ``entry`` (the first
    ``(round + 1) * step`` bits), ``depth``, ``prefix``, ``shard_bytes``, ``shard_docs``
    and ``same`` (no bit can split the shard: its rows have one hash).
    """
    levels, rows, base = [], keys, 0
    while True:
        deep = min(base + step, BITS)
        entry = F.expr(f"shiftright(h, {BITS - deep})")
        sums = rows.groupBy(entry.alias("entry")).agg(
            F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("docs"),
            F.min("h").alias("least"), F.max("h").alias("most"),
        )
        first = base + 1 if base else 0
        depths = F.sequence(F.lit(first), F.lit(deep)).alias("depths")
        spread = sums.select("*", F.explode(depths).alias("depth"))
        spread = spread.withColumn("prefix", F.expr(f"shiftright(entry, {deep} - depth)"))
        shards = spread.groupBy("depth", "prefix").agg(
            F.sum("bytes").alias("shard_bytes"), F.sum("docs").alias("shard_docs"),
            (F.min("least") == F.max("most")).alias("same"),
        )
        shards = shards.withColumn("fits", (F.col("shard_bytes") <= limit) | F.col("same"))
        # the least depth at which an entry's shard fits
        entries = spread.select("entry", "depth", "prefix").join(shards.where("fits"), ["depth", "prefix"])
        entries = entries.groupBy("entry").agg(F.min_by(F.struct("depth", "prefix", "shard_bytes", "shard_docs", "same"), "depth").alias("s"))
        level = store(entries.select(F.lit(len(levels)).alias("round"), "entry", "s.*"), "shard_directory")
        levels.append(level)
        unfit = sums.join(level.select("entry"), "entry", "left_anti").select("entry")
        unfit = store(unfit, "shard_splits")
        if unfit.isEmpty():
            break
        rows = rows.withColumn("entry", entry).join(unfit, "entry", "left_semi").select("h", "bytes")
        base = deep
    found = levels[0]
    for level in levels[1:]:
        found = found.unionByName(level)
    return found


def shard(
    docs: DataFrame, key: str = "doc_id", content: str = "text", limit: int = LIMIT_BYTES, step: int = STEP
) -> DataFrame:
    """``docs`` with ``n_bytes``, ``shard`` (``depth-prefix``), ``depth``, ``shard_bytes``,
    ``shard_docs`` and ``oversized``; columns of these names are replaced."""
    size = F.coalesce(F.octet_length(F.col(quoted(content))), F.lit(0)).cast("long")
    keys = store(docs.select(content_hash(key, content).alias("h"), size.alias("bytes")), "shard_keys")
    entries = directory(keys, limit, step)
    rounds = (entries.agg(F.max("round")).first()[0] or 0) + 1
    added = ["n_bytes", "shard", "depth", "shard_bytes", "shard_docs", "oversized"]
    others = [F.col(quoted(c)) for c in docs.columns if c.lower() not in added]
    plain = docs.select(
        F.struct(*others).alias("row"), content_hash(key, content).alias("h"), size.alias("n_bytes")
    )
    fields = ["depth", "prefix", "shard_bytes", "shard_docs", "same"]
    for r in range(rounds):
        level = entries.where(F.col("round") == r).select(F.col("entry").alias(f"e{r}"), F.struct(*fields).alias(f"s{r}"))
        at = F.expr(f"shiftright(h, {BITS - min((r + 1) * step, BITS)})")
        plain = plain.join(level, at == F.col(f"e{r}"), "left").drop(f"e{r}")
    placed = plain.withColumn("s", F.coalesce(*[F.col(f"s{r}") for r in range(rounds)]))
    whole = F.concat_ws("-", "s.depth", "s.prefix")
    over = F.col("s.shard_bytes") > limit
    split = placed.where(~(over & F.col("s.same") & (F.col("s.shard_docs") > 1)))
    split = split.select("row.*", "n_bytes", whole.alias("shard"), "s.depth", "s.shard_bytes", "s.shard_docs", over.alias("oversized"))
    # rows that no bit can tell apart: counted, then dealt out by number
    equal = placed.where(over & F.col("s.same") & (F.col("s.shard_docs") > 1))
    counted = equal.groupBy("row", "n_bytes", "s").agg(F.count(F.lit(1)).alias("rows"))
    room = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(limit) / F.col("n_bytes")))
    parts = counted.withColumn("room", room).withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("rows") / F.col("room")) - 1))
    )
    parts = parts.withColumn("docs", F.least("room", F.col("rows") - F.col("part") * F.col("room")))
    parts = parts.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("docs"))))
    dealt = parts.select(
        "row.*", "n_bytes", F.concat_ws("-", whole, F.hex(F.xxhash64("row")), "part").alias("shard"), "s.depth",
        (F.col("docs") * F.col("n_bytes")).alias("shard_bytes"), F.col("docs").alias("shard_docs"), (F.col("n_bytes") > limit).alias("oversized"),
    )
    return split.unionByName(dealt)


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard.  A shard is at most the byte limit, so one task writes it."""
    sharded.repartition("shard").write.partitionBy("shard").parquet(path)
