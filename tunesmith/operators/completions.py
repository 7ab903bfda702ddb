"""Completions that are made once: resumable generation and a kept cache."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunesmith.operators.inference import DecodeProfile, Generator, complete
from tunesmith.session import new_folder

UNITS = 1024
WAVES = 16


def resumable_completions(
    df: DataFrame,
    loader: Callable[[DecodeProfile], Generator],
    profile: DecodeProfile,
    out: str,
    key: str | list[str] = "pos",
    prompt: str = "prompt",
    completion: str = "completion",
    batch_size: int = 32,
    units: int = UNITS,
    waves: int = WAVES,
) -> DataFrame:
    """``complete``, kept in the folder ``out``; a second call makes only what is missing.

    Rows are dealt to ``units`` work units by their key.  ``waves`` jobs complete them one
    after another; each replaces the folders of its units under ``out/completions`` and
    then adds a row per unit to ``out/commits``.  A job that fails or is stopped loses the
    calls of its wave, and of no other; a restart plans only units without a commit.  A
    commit holds the profile and a fingerprint of its rows, so a unit whose rows have
    changed since is made again and no other is.

    One row per unit reaches the driver.  Rows with null keys share a unit; repeated rows
    are completed each.  An empty table gives none and calls nothing.
    """
    spark = df.sparkSession
    keys = [key] if isinstance(key, str) else list(key)
    made, commits, source = f"{out}/completions", f"{out}/commits", new_folder(spark, "prompt-units")
    rows = df.drop(completion)
    dealt = rows.withColumn("unit", F.pmod(F.xxhash64(*keys), F.lit(units)).cast("int"))
    # stored by unit, so that a wave reads its own rows only
    dealt.repartition("unit").write.partitionBy("unit").parquet(source)
    stored = spark.read.schema(dealt.schema).parquet(source)
    hashed = F.xxhash64(F.lit(profile.key), *keys, prompt)
    prints = stored.groupBy("unit").agg(
        F.count(F.lit(1)).alias("n"), F.sum(hashed.cast("decimal(38,0)")).cast("string").alias("print")
    )
    wanted = {r.unit: (r.n, r.print) for r in prints.collect()}
    schema = "unit int, n bigint, print string, at timestamp"
    known = {r.unit: (r.n, r.print) for r in _existing(spark, commits, schema).groupBy("unit").agg(
        F.max_by("n", "at").alias("n"), F.max_by("print", "at").alias("print")).collect()}
    todo = sorted(u for u in wanted if known.get(u) != wanted[u])
    size = max(1, -(-units // waves))
    for at in range(0, len(todo), size):
        wave = todo[at : at + size]
        part = stored.where(F.col("unit").isin(wave)).repartitionByRange(len(wave), "unit")
        done = complete(part, loader, profile, prompt, completion, batch_size)
        done.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("unit").parquet(made)
        noted = spark.createDataFrame([(u, *wanted[u]) for u in wave], "unit int, n bigint, print string")
        noted.withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(commits)
    result = dealt.withColumn(completion, F.lit("").cast("string")).schema
    every = _existing(spark, made, result)
    # units that the rows no longer reach keep their folders but are not given back
    return every.where(F.col("unit").isin(sorted(wanted))).select(*rows.columns, completion)


def _existing(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table in a folder, or an empty one where there is none yet."""
    return spark.read.schema(schema).parquet(path) if _there(spark, path) else spark.createDataFrame([], schema)


def _there(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


@dataclass(frozen=True)
class CompletionCache:
    """Completions by ``(prompt_id, model_id, decode_hash)``, as a table of this session.

    The table lies in ``path``, is divided by model, setting and commit, and bucketed by
    ``prompt_id``: a look-up reads one model and setting and does not move the cache.
    Sessions that find files in ``path`` take them over.
    """

    spark: SparkSession
    table: str
    path: str
    key_type: str = "bigint"
    buckets: int = 64

    def __post_init__(self):
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (prompt_id {self.key_type}, completion STRING, model_id STRING, "
            f"decode_hash STRING, commit STRING) USING parquet PARTITIONED BY (model_id, decode_hash, commit) "
            f"CLUSTERED BY (prompt_id) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )
        if _there(self.spark, self.path):
            self.spark.sql(f"ALTER TABLE {self.table} RECOVER PARTITIONS")

    def completions(self, model: str, profile: DecodeProfile) -> DataFrame:
        """``(prompt_id, completion)`` of a model and setting, one for each id.

        Two runs at once may both have completed a prompt; the smaller text counts.  Ids
        lie in their buckets, so this is no shuffle.
        """
        rows = self.spark.table(self.table).where((F.col("model_id") == model) & (F.col("decode_hash") == profile.key))
        return rows.groupBy("prompt_id").agg(F.min("completion").alias("completion"))

    def missing(self, prompts: DataFrame, model: str, profile: DecodeProfile) -> DataFrame:
        """Prompts that the cache does not hold."""
        return prompts.join(self.completions(model, profile).select("prompt_id"), "prompt_id", "left_anti")

    def append(self, fresh: DataFrame, model: str, profile: DecodeProfile, commit: str) -> None:
        """Keep ``(prompt_id, completion)``; the same ``commit`` replaces what it wrote before."""
        rows = fresh.select("prompt_id", "completion", F.lit(model).alias("model_id"),
                            F.lit(profile.key).alias("decode_hash"), F.lit(commit).alias("commit"))
        rows = rows.repartition(self.buckets, "prompt_id")
        name = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(name)
        self.spark.conf.set(name, "dynamic")
        try:
            rows.write.insertInto(self.table, overwrite=True)
        finally:
            self.spark.conf.set(name, before)

    def fill(self, prompts: DataFrame, loader: Callable[[DecodeProfile], Generator], model: str,
             profile: DecodeProfile, batch_size: int = 32) -> DataFrame:
        """``(prompt_id, prompt)`` -> ``(prompt_id, completion)``; what was missing is made and kept.

        The commit is named by the missing prompts, so a repeated job writes it again
        instead of adding to it.
        """
        todo = self.missing(prompts, model, profile).select("prompt_id", "prompt")
        total = F.sum(F.xxhash64("prompt_id", "prompt").cast("decimal(38,0)"))
        n, name = todo.agg(F.count(F.lit(1)), F.md5(total.cast("string"))).first()
        if n:
            self.append(complete(todo, loader, profile, batch_size=batch_size), model, profile, f"{n}-{name}")
        return self.completions(model, profile).join(prompts.select("prompt_id"), "prompt_id", "left_semi")
