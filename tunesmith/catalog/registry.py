"""How queries are registered, and the bindings several of them share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Entry:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def registrar(entries: dict[str, Entry]):
    """``@register(sql)`` puts a function into ``entries`` under its own name."""

    def register(sql: str | None = None):
        def add(fn):
            entries[fn.__name__] = Entry(fn, sql)
            return fn

        return add

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def joined(array: str, sep: str = ","):
    """An array column as one string, so that results compare as plain values."""
    return F.array_join(F.col(array).cast("array<string>"), sep)


# --- shared SQL -------------------------------------------------------------------

WORDS = r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]"
TOKENS = (
    r"\p{L}+|\p{N}+|<\|pad\|>|<\|im_start\|>|<\|im_end\|>|<\|vision_start\|>"
    r"|<\|vision_end\|>|<\|image_pad\|>|<\|video_pad\|>|[^\s\p{L}\p{N}]"
)


def exchange_cte(source: str = "conversations") -> str:
    """CTEs ending in ``fx(conv_id, prompt, completion)``: first exchanges."""
    return f"""
    fu AS (SELECT conv_id, min(turn) AS ut FROM {source} WHERE role = 'user' GROUP BY conv_id),
    fa AS (SELECT c.conv_id, min(c.turn) AS at FROM {source} c JOIN fu USING (conv_id)
           WHERE c.role = 'assistant' AND c.turn > fu.ut GROUP BY c.conv_id),
    fx AS (SELECT fu.conv_id, p.text AS prompt, r.text AS completion
           FROM fu JOIN fa USING (conv_id)
           JOIN {source} p ON p.conv_id = fu.conv_id AND p.turn = fu.ut
           JOIN {source} r ON r.conv_id = fu.conv_id AND r.turn = fa.at)"""


VOCAB_SIZE = 2000


def vocab_cte(source: str = "documents", size: int | None = VOCAB_SIZE) -> str:
    cut = f"ORDER BY n DESC, tok LIMIT {size}" if size else ""
    return f"""
    words AS (SELECT unnest(regexp_extract_all(text, '{WORDS}')) AS tok FROM {source}),
    counted AS (SELECT tok, count(*) AS n FROM words GROUP BY tok {cut}),
    vocab AS (SELECT tok, n, row_number() OVER (ORDER BY n DESC, tok) + 3 AS id FROM counted)"""


def encode_cte(base: str, key: str, p: str = "") -> str:
    """CTEs ending in ``{p}num``: one row per token of the rendered exchange in ``base``."""
    return f"""
    {p}seg AS (
      SELECT {key}, 0 AS s, 0 AS g, '<|im_start|>system' || chr(10) || 'You are a helpful assistant.<|im_end|>' AS txt FROM {base}
      UNION ALL SELECT {key}, 1, 0, '<|im_start|>user' || chr(10) FROM {base}
      UNION ALL SELECT {key}, 2, 0, prompt FROM {base}
      UNION ALL SELECT {key}, 3, 0, '<|im_end|>' FROM {base}
      UNION ALL SELECT {key}, 4, 0, '<|im_start|>assistant' || chr(10) FROM {base}
      UNION ALL SELECT {key}, 5, 1, completion FROM {base}
      UNION ALL SELECT {key}, 6, 0, '<|im_end|>' FROM {base}),
    {p}lst AS (SELECT {key}, s, g, regexp_extract_all(txt, '{TOKENS}') AS toks FROM {p}seg),
    {p}tok AS (SELECT {key}, s, g, unnest(toks) AS tok, generate_subscripts(toks, 1) AS i FROM {p}lst),
    {p}num AS (
      SELECT t.{key}, g,
             CASE t.tok WHEN '<|pad|>' THEN 0 WHEN '<|im_start|>' THEN 1 WHEN '<|im_end|>' THEN 2
                        ELSE coalesce(v.id, 3) END AS id,
             row_number() OVER (PARTITION BY t.{key} ORDER BY s, i) AS k,
             count(*) OVER (PARTITION BY t.{key}) AS n_tok
      FROM {p}tok t LEFT JOIN vocab v ON v.tok = t.tok)"""


def offset_cte(base: str, key: str, p: str = "", width: int = 3, size: int = 50_000) -> str:
    """CTEs ending in ``{p}num`` for the hashing tokenizer: tokens of the whole rendered
    text, cut without regard to segments and held against the place of the reply."""
    return rf"""
    {p}txt AS (
      SELECT {key}, '<|im_start|>system' || chr(10) || 'You are a helpful assistant.<|im_end|>' || chr(10)
          || '<|im_start|>user' || chr(10) || prompt || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) AS lead,
        completion, '<|im_end|>' || chr(10) AS tail FROM {base}),
    {p}lst AS (SELECT {key}, length(lead) AS a, length(lead) + length(completion) AS b,
        regexp_extract_all(lead || completion || tail, '<\|pad\|>|<\|im_start\|>|<\|im_end\|>|[^<]{{1,{width}}}|<') AS toks FROM {p}txt),
    {p}tok AS (SELECT {key}, a, b, unnest(toks) AS tok, generate_subscripts(toks, 1) AS i FROM {p}lst),
    {p}put AS (SELECT *, sum(length(tok)) OVER (PARTITION BY {key} ORDER BY i) AS e FROM {p}tok),
    {p}num AS (
      SELECT {key}, CASE WHEN e - length(tok) < b AND e > a THEN 1 ELSE 0 END AS g,
             CASE tok WHEN '<|pad|>' THEN 0 WHEN '<|im_start|>' THEN 1 WHEN '<|im_end|>' THEN 2
                      ELSE 4 + ('0x' || substr(md5(tok), 1, 8))::BIGINT % {size} END AS id,
             i AS k, count(*) OVER (PARTITION BY {key}) AS n_tok
      FROM {p}put)"""
