"""Categories, criteria and revision prompts."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import md5

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunesmith.exemplars import EXEMPLARS
from tunesmith.fixed_values import CRITERIA
from tunesmith.functions.text import revision_prompt, split_words
from tunesmith.functions.vectors import dot, norm
from tunesmith.operators.align import zip_join
from tunesmith.operators.chat import exchange
from tunesmith.operators.position import head_n
from tunesmith.session import store

#: Words whose place a worker remembers.
CACHED_WORDS = 1 << 16

Embedder = Callable[[list[str]], list[list[float]]]


def default_criteria(spark: SparkSession) -> DataFrame:
    """The eight built-in categories as ``(ord, category, criterion)``."""
    rows = [(i, name, text) for i, (name, text) in enumerate(CRITERIA)]
    return spark.createDataFrame(rows, "ord INT, category STRING, criterion STRING")


def default_exemplars(spark: SparkSession) -> DataFrame:
    """The built-in example prompts as ``(ord, category, example)``."""
    rows = [(i, name, text) for i, (name, texts) in enumerate(EXEMPLARS) for text in texts]
    return spark.createDataFrame(rows, "ord INT, category STRING, example STRING")


def embed(
    df: DataFrame,
    loader: Callable[[], Embedder],
    text: str = "text",
    vector: str = "embedding",
    batch_size: int = 256,
) -> DataFrame:
    """Add a vector per text with a model that ``loader`` opens once per task."""
    schema = df.drop(vector).withColumn(vector, F.array(F.lit(0.0).cast("float"))).schema

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = loader()
        for frame in frames:
            texts = frame[text].fillna("").tolist()
            vectors: list = []
            for i in range(0, len(texts), batch_size):
                vectors.extend(encode(texts[i : i + batch_size]))
            yield frame.assign(**{vector: vectors})

    return df.mapInPandas(run, schema)


def embed_tfidf(
    df: DataFrame, key: str = "doc_id", text: str = "text", vector: str = "embedding", dim: int = 256
) -> DataFrame:
    """Model-free vectors ``(key, vector)``: hashed word counts, inverse document weights,
    unit length; ``key`` is unique.

    A word counts in the place that the first 32 bits of its md5 give, modulo ``dim``.
    The weights, ``ln((rows + 1) / (rows with the place + 1))``, are one value of at most
    ``dim`` numbers.  A text without words has the zero vector.  Words are counted inside
    their row before anything is shuffled; the counts per place are stored.
    """
    lines = F.array_join(split_words(F.lower(F.col(text))), "\n")
    own = df.select(key, _place_counts(dim)(lines).alias("own")).select(key, F.explode(F.arrays_zip("own.i", "own.n")).alias("c"))
    # stored, since both the weights and the rows are made of it
    counts = store(own.groupBy(key, F.col("c.i").alias("i")).agg(F.sum("c.n").alias("n")), "place-counts")
    found = counts.groupBy("i").agg(F.count(F.lit(1)).alias("docs"))
    total = df.agg(F.count(F.lit(1))).scalar()
    # as many rows as there are places: Spark sees the small side by itself
    weighted = counts.join(found, "i").select(
        key, "i", (F.col("n") * F.log((total + F.lit(1.0)) / (F.col("docs") + F.lit(1.0)))).alias("x")
    )
    rows = weighted.groupBy(key).agg(
        F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"), F.collect_list(F.struct("i", "x")).alias("e")
    )
    unit = F.transform("e", lambda e: F.struct(e["i"].alias("i"), F.coalesce(F.try_divide(e["x"], F.col("norm")), F.lit(0.0)).alias("x")))
    places = F.sequence(F.lit(0), F.lit(dim - 1))
    found_at = lambda m, i: F.coalesce(F.try_element_at(m, i), F.lit(0.0))
    # a one-element array binds the map, so that it is made once per row
    filled = F.transform(F.array(F.map_from_entries(unit)), lambda m: F.transform(places, lambda i: found_at(m, i)))[0]
    return df.select(key).join(rows, key, "left").select(key, filled.alias(vector))


def _place_counts(dim: int):
    """Words, one per line, as the places they fall into (rising) and how many do."""

    class Places(dict):
        def __missing__(self, word: str) -> int:
            if len(self) >= CACHED_WORDS:
                self.clear()
            place = self[word] = int(md5(word.encode()).hexdigest()[:8], 16) % dim
            return place

    places = Places()

    @F.pandas_udf("struct<i: array<int>, n: array<int>>")
    def run(lines: pd.Series) -> pd.DataFrame:
        at, n = [], []
        for text in lines:
            words = text.split("\n") if text else []
            i, times = np.unique(np.fromiter(map(places.__getitem__, words), np.int32, len(words)), return_counts=True)
            at.append(i)
            n.append(times.astype(np.int32))
        return pd.DataFrame({"i": at, "n": n})

    return run


def centroids(exemplars: DataFrame, vector: str = "embedding") -> DataFrame:
    """``(ord, category, <vector>)`` exemplars -> ``(ord, category, vec)`` means.

    Averages are combined map-side: what is shuffled is categories x dimensions
    per task, however many exemplars there are.
    """
    means = (
        exemplars.select("ord", "category", F.posexplode(vector).alias("i", "v"))
        .groupBy("ord", "category", "i")
        .agg(F.avg(F.col("v").cast("double")).alias("v"))
    )
    return means.groupBy("ord", "category").agg(
        F.array_sort(F.collect_list(F.struct("i", "v")))["v"].alias("vec")
    )


def assign_nearest(
    df: DataFrame, category_vectors: DataFrame, vector: str = "embedding", carry: tuple[str, ...] = ()
) -> DataFrame:
    """Add ``category`` and ``similarity`` of the closest mean vector by cosine.

    ``carry`` names further columns of ``category_vectors`` that the rows get, too.

    Equal similarities go to the lower ``ord``.  All means form one value
    (categories x dimensions numbers) that a subquery computes once; the rows
    themselves are neither exploded nor shuffled.
    """
    cols = df.columns
    table = category_vectors.agg(
        F.collect_list(
            F.struct(F.col("ord").cast("int").alias("ord"), "category", "vec", norm(F.col("vec")).alias("len"), *carry)
        ).alias("means")
    ).scalar()
    # the row's own length is the same for every mean: divided by once, at the end
    best = F.array_max(
        F.transform(
            "_means",
            lambda m: F.struct(
                F.coalesce(F.try_divide(dot(F.col(vector), m["vec"]), m["len"]), F.lit(0.0)).alias(
                    "projection"
                ),
                (-m["ord"]).alias("rank"),
                m["category"].alias("category"),
                *[m[c].alias(c) for c in carry],
            ),
        )
    )
    length = norm(F.col(vector))
    return (
        df.withColumn("_means", table)
        .select(*cols, best.alias("_best"))
        .select(
            *cols,
            F.col("_best.category").alias("category"),
            *[F.col(f"_best.{c}").alias(c) for c in carry],
            F.coalesce(F.try_divide(F.col("_best.projection"), length), F.lit(0.0)).alias(
                "similarity"
            ),
        )
    )


def criteria_dataset(
    prompts: DataFrame,
    category_vectors: DataFrame,
    criteria: DataFrame,
    vector: str = "embedding",
) -> DataFrame:
    """``(pos, prompt, <vector>)`` -> records ``(pos, x, y, c)`` with an empty ``y``.

    The criteria join the category means (a row per category), not the prompts: these are
    neither joined nor shuffled, however few categories they fall into.  A prompt whose
    category has no criterion fails the job.
    """
    means = category_vectors.join(criteria.select("category", "criterion"), "category", "left")
    assigned = assign_nearest(prompts, means, vector, carry=("criterion",))
    missing = F.raise_error(F.concat(F.lit("no criterion for "), F.col("category")))
    return assigned.select(
        "pos",
        F.col("prompt").alias("x"),
        F.lit("").alias("y"),
        F.coalesce(F.col("criterion"), missing.cast("string")).alias("c"),
    )


def revision_prompts(records: DataFrame, first_replies: DataFrame) -> DataFrame:
    """``(pos, x, c)`` zipped with ``(pos, completion)`` -> ``(pos, prompt)``."""
    return zip_join(records.select("pos", "x", "c"), first_replies.select("pos", "completion")).select(
        "pos", revision_prompt(F.col("x"), F.col("c"), F.col("completion")).alias("prompt")
    )


def revision_dataset(
    records: DataFrame,
    first_replies: DataFrame,
    revisions: DataFrame,
    max_samples: int | None = None,
) -> DataFrame:
    """Revision prompt and teacher revision per position, as exchanges.

    The limit is on the records and first replies; revisions are cut by the zip.
    """
    prompts = revision_prompts(head_n(records, max_samples), head_n(first_replies, max_samples))
    return zip_join(prompts, revisions.select("pos", "completion")).select(
        "pos",
        "prompt",
        "completion",
        exchange(F.col("prompt"), F.col("completion")).alias("messages"),
    )
