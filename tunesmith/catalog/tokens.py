"""Bindings for vocabularies, token rows, batches and epoch plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from tunesmith import fixed_values as V
from tunesmith.catalog.chat import PAIRS_CTE, preference_pairs
from tunesmith.catalog.records import REVISION_CTE, revision_inputs
from tunesmith.catalog.registry import (
    TOKENS,
    VOCAB_SIZE,
    WORDS,
    Entry,
    encode_cte,
    exchange_cte,
    joined,
    offset_cte,
    registrar,
    table,
    vocab_cte,
)
from tunesmith.functions.text import split_words
from tunesmith.functions.tokenizers import hashing_tokenizer
from tunesmith.functions.tokenrows import labels_from_mask, mask_with_end
from tunesmith.operators.batches import (
    curriculum_plan,
    difficulty_buckets,
    epoch_plan,
    make_batches,
)
from tunesmith.operators.chat import exchange, first_exchange, render_chat
from tunesmith.operators.criteria import revision_dataset
from tunesmith.operators.permute import MIX, PRIME, ROUNDS, batch_positions, curriculum_places, epoch_places
from tunesmith.operators.position import with_position
from tunesmith.operators.tokens import (
    build_vocab,
    encode,
    fit_length,
    overflow_counts,
    pad_examples,
    pad_preferences,
    preference_examples,
    revision_examples,
    sft_examples,
    truncate_prompts,
)
from tunesmith.session import store

ENTRIES: dict[str, Entry] = {}
register = registrar(ENTRIES)


def vocabulary(spark, sf):
    """Counted once and stored, as a training run keeps it."""
    return store(build_vocab(table(spark, sf, "documents"), VOCAB_SIZE), "vocabulary")


@register(f"WITH {vocab_cte()} SELECT tok, n, id::INT AS id FROM vocab")
def tk1_build_vocab(spark, sf):
    return build_vocab(table(spark, sf, "documents"), VOCAB_SIZE)


@register(f"WITH {vocab_cte(size=None)} SELECT tok, n, id::INT AS id FROM vocab")
def tk1_build_vocab_of_all_words(spark, sf):
    return build_vocab(table(spark, sf, "documents"), None)


def _encoded_exchanges(spark, sf):
    chat = first_exchange(table(spark, sf, "conversations")).select(
        "conv_id", exchange(F.col("prompt"), F.col("completion")).alias("messages")
    )
    return encode(render_chat(chat), vocabulary(spark, sf)).select("conv_id", "ids", "generated")


_FX = f"{exchange_cte()}, {vocab_cte()}, {encode_cte('fx', 'conv_id')}"


@register(
    f"""WITH {_FX} SELECT conv_id, string_agg(id::VARCHAR, ',' ORDER BY k) AS ids,
        string_agg(g::VARCHAR, ',' ORDER BY k) AS generated FROM num GROUP BY conv_id"""
)
def tk2_encode(spark, sf):
    return _encoded_exchanges(spark, sf).select(
        "conv_id", joined("ids").alias("ids"), joined("generated").alias("generated")
    )


def _document_segments(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        F.array(F.struct("text", F.lit(False).alias("generated"))).alias("segments"),
    )


def _documents_sql(size: int | None) -> str:
    return f"""WITH {vocab_cte(size=size)},
        toks AS (SELECT doc_id, regexp_extract_all(text, '{TOKENS}') AS l FROM documents),
        flat AS (SELECT doc_id, unnest(l) AS tok, generate_subscripts(l, 1) AS i FROM toks)
        SELECT doc_id, count(*) AS n, string_agg(coalesce(id, 3)::VARCHAR, ',' ORDER BY i) AS ids
        FROM flat LEFT JOIN vocab USING (tok) GROUP BY doc_id"""


@register(_documents_sql(None))
def tk2_encode_with_all_words(spark, sf):
    """No word is unknown; the vocabulary is joined, as one of any size can be."""
    vocab = store(build_vocab(table(spark, sf, "documents"), None), "vocabulary")
    rows = encode(_document_segments(spark, sf), vocab, by_join=True)
    return rows.select("doc_id", F.size("ids").cast("bigint").alias("n"), joined("ids").alias("ids"))


@register(_documents_sql(VOCAB_SIZE))
def tk2_encode_documents(spark, sf):
    rows = encode(_document_segments(spark, sf), vocabulary(spark, sf))
    return rows.select("doc_id", F.size("ids").cast("bigint").alias("n"), joined("ids").alias("ids"))


_LAST = "max(CASE WHEN id = 2 THEN k END) OVER (PARTITION BY {key}) AS last_end"


@register(
    f"""WITH {_FX}, ends AS (SELECT *, {_LAST.format(key='conv_id')} FROM num)
        SELECT conv_id,
          string_agg(CASE WHEN g = 1 OR k = last_end THEN '1' ELSE '0' END, ',' ORDER BY k) AS mask,
          string_agg((CASE WHEN g = 1 OR k = last_end THEN id ELSE -100 END)::VARCHAR, ','
                     ORDER BY k) AS labels
        FROM ends GROUP BY conv_id"""
)
def tk3_tk4_masks_and_labels(spark, sf):
    """Over whole exchanges; cut ones are tested by the length policies."""
    rows = _encoded_exchanges(spark, sf).withColumn(
        "mask", mask_with_end(F.col("ids"), F.col("generated"))
    )
    rows = rows.withColumn("labels", labels_from_mask(F.col("ids"), F.col("mask")))
    return rows.select("conv_id", joined("mask").alias("mask"), joined("labels").alias("labels"))


_COUNTS = f"SELECT doc_id, len(regexp_extract_all(text, '{TOKENS}')) AS n FROM documents"


@register(f"SELECT doc_id, least(n, 512) AS n_tokens FROM ({_COUNTS})")
def tk5_fit_length_truncate(spark, sf):
    rows = encode(_document_segments(spark, sf), vocabulary(spark, sf))
    return fit_length(rows, V.REVISION_LENGTH, "truncate").select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens")
    )


@register(f"SELECT doc_id, n AS n_tokens FROM ({_COUNTS}) WHERE n <= 720")
def tk5_fit_length_drop(spark, sf):
    rows = encode(_document_segments(spark, sf), vocabulary(spark, sf))
    return fit_length(rows, V.SFT_LENGTH, "drop").select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens")
    )


@register(
    f"""SELECT count(*) AS n_rows,
          count(*) FILTER (WHERE len(regexp_extract_all(text, '{TOKENS}')) > 720) AS n_too_long
        FROM documents"""
)
def tk5_overflow_counts(spark, sf):
    rows = encode(_document_segments(spark, sf), vocabulary(spark, sf))
    return overflow_counts(rows, V.SFT_LENGTH)


def _pad_sql(list_sql: str, length: int, value: int) -> str:
    return f"array_to_string(list_resize({list_sql}, {length}, {value}), ',')"


def _rows_sql(base_cte: str, length: int, where: str) -> str:
    return f"""WITH {base_cte},
        ends AS (SELECT *, {_LAST.format(key='conv_id')} FROM num WHERE {where}),
        lists AS (SELECT conv_id, list(id::INT ORDER BY k) AS ids,
            list((CASE WHEN g = 1 OR k = last_end THEN id ELSE -100 END)::INT ORDER BY k) AS labels,
            list(1 ORDER BY k) AS att FROM ends GROUP BY conv_id)
        SELECT conv_id, {_pad_sql('ids', length, 0)} AS input_ids,
               {_pad_sql('att', length, 0)} AS attention_mask,
               {_pad_sql('labels', length, -100)} AS labels FROM lists"""


@register(_rows_sql(_FX, V.SFT_LENGTH, f"n_tok <= {V.SFT_LENGTH}"))
def tk6_sft_examples(spark, sf):
    rows = sft_examples(table(spark, sf, "conversations"), vocabulary(spark, sf))
    return pad_examples(rows, V.SFT_LENGTH).select(
        "conv_id", *[joined(c).alias(c) for c in ("input_ids", "attention_mask", "labels")]
    )


_OUTSIDE = f"{exchange_cte()}, {offset_cte('fx', 'conv_id')}"


@register(
    f"""WITH {_OUTSIDE} SELECT conv_id, string_agg(id::VARCHAR, ',' ORDER BY k) AS ids,
        string_agg(g::VARCHAR, ',' ORDER BY k) AS generated FROM num GROUP BY conv_id"""
)
def tk2_encode_with_spans(spark, sf):
    """An outside tokenizer, whose tokens cross the borders of segments."""
    chat = first_exchange(table(spark, sf, "conversations")).select(
        "conv_id", exchange(F.col("prompt"), F.col("completion")).alias("messages")
    )
    rows = encode(render_chat(chat), hashing_tokenizer())
    return rows.select("conv_id", joined("ids").alias("ids"), joined("generated").alias("generated"))


@register(_rows_sql(_OUTSIDE, V.SFT_LENGTH, f"n_tok <= {V.SFT_LENGTH}"))
def tk6_sft_examples_outside(spark, sf):
    tokenizer = hashing_tokenizer()
    rows = sft_examples(table(spark, sf, "conversations"), tokenizer)
    return pad_examples(rows, V.SFT_LENGTH, tokenizer.pad_id).select(
        "conv_id", *[joined(c).alias(c) for c in ("input_ids", "attention_mask", "labels")]
    )


def _side_sql(side: str, cte=encode_cte) -> str:
    p = side[0]
    return f"""
      {p}pairs AS (SELECT conv_id, prompt, {side} AS completion FROM pairs),
      {cte(f'{p}pairs', 'conv_id', p)},
      {p}ends AS (SELECT *, {_LAST.format(key='conv_id')} FROM {p}num
                  WHERE n_tok <= {V.PREFERENCE_LENGTH}),
      {p}out AS (SELECT conv_id, list(id::INT ORDER BY k) AS ids, list(1 ORDER BY k) AS att,
          list((CASE WHEN g = 1 OR k = last_end THEN 1 ELSE 0 END)::INT ORDER BY k) AS mask
          FROM {p}ends GROUP BY conv_id)"""


_BOTH_SIDES = ", ".join(
    f"{_pad_sql(f'{s[0]}out.{c}', V.PREFERENCE_LENGTH, 0)} AS {s}_{n}"
    for s in ("chosen", "rejected")
    for c, n in (("ids", "input_ids"), ("att", "attention_mask"), ("mask", "assistant_masks"))
)


@register(
    f"""WITH {PAIRS_CTE}, {vocab_cte()}, {_side_sql('chosen')}, {_side_sql('rejected')}
        SELECT conv_id, {_BOTH_SIDES} FROM cout JOIN rout USING (conv_id)"""
)
def tk7_preference_examples(spark, sf):
    return _padded_preferences(preference_examples(preference_pairs(spark, sf), vocabulary(spark, sf)))


@register(
    f"""WITH {PAIRS_CTE}, {_side_sql('chosen', offset_cte)}, {_side_sql('rejected', offset_cte)}
        SELECT conv_id, {_BOTH_SIDES} FROM cout JOIN rout USING (conv_id)"""
)
def tk7_preference_examples_outside(spark, sf):
    return _padded_preferences(preference_examples(preference_pairs(spark, sf), hashing_tokenizer()))


def _padded_preferences(rows):
    padded = pad_preferences(rows)
    return padded.select("conv_id", *[joined(c).alias(c) for c in padded.columns if c != "conv_id"])


_REVISED = f"""every AS (SELECT DISTINCT conv_id FROM conversations),
    cut AS (SELECT * FROM num WHERE k <= {V.REVISION_LENGTH}),
    used AS (SELECT conv_id FROM cut GROUP BY conv_id HAVING max(g) = 1),
    ends AS (SELECT *, {_LAST.format(key='conv_id')} FROM cut SEMI JOIN used USING (conv_id)),
    lists AS (SELECT conv_id, list(id::INT ORDER BY k) AS ids, list(1 ORDER BY k) AS att,
        list((CASE WHEN g = 1 OR k = last_end THEN id ELSE -100 END)::INT ORDER BY k) AS labels
        FROM ends GROUP BY conv_id)
    SELECT conv_id,
          {_pad_sql('coalesce(ids, [])', V.REVISION_LENGTH, 0)} AS input_ids,
          {_pad_sql('coalesce(att, [])', V.REVISION_LENGTH, 0)} AS attention_mask,
          {_pad_sql('coalesce(labels, [])', V.REVISION_LENGTH, -100)} AS labels,
          ids IS NOT NULL AS valid
        FROM every LEFT JOIN lists USING (conv_id)"""


@register(f"WITH {_OUTSIDE}, {_REVISED}")
def tk8_revision_examples_outside(spark, sf):
    tokenizer = hashing_tokenizer()
    exchanges = first_exchange(table(spark, sf, "conversations"), "flag")
    rows = revision_examples(exchanges, tokenizer, "conv_id")
    return pad_examples(rows, V.REVISION_LENGTH, tokenizer.pad_id).select(
        "conv_id", "valid", *[joined(c).alias(c) for c in ("input_ids", "attention_mask", "labels")]
    )


@register(f"WITH {exchange_cte()}, {vocab_cte()}, {encode_cte('fx', 'conv_id')}, {_REVISED}")
def tk8_revision_examples(spark, sf):
    exchanges = first_exchange(table(spark, sf, "conversations"), "flag")
    rows = revision_examples(exchanges, vocabulary(spark, sf), "conv_id")
    return pad_examples(rows, V.REVISION_LENGTH).select(
        "conv_id", "valid", *[joined(c).alias(c) for c in ("input_ids", "attention_mask", "labels")]
    )


@register(
    f"""WITH {REVISION_CTE}, {vocab_cte()}, {encode_cte('revs', 'pos')},
        cut AS (SELECT * FROM num WHERE k <= {V.REVISION_LENGTH}),
        used AS (SELECT pos FROM cut GROUP BY pos HAVING max(g) = 1),
        ends AS (SELECT *, {_LAST.format(key='pos')} FROM cut SEMI JOIN used USING (pos))
        SELECT revs.pos, used.pos IS NOT NULL AS valid, coalesce(ids, '') AS ids,
               coalesce(labels, '') AS labels
        FROM revs LEFT JOIN used USING (pos) LEFT JOIN (
          SELECT pos, string_agg(id::VARCHAR, ',' ORDER BY k) AS ids,
            string_agg((CASE WHEN g = 1 OR k = last_end THEN id ELSE -100 END)::VARCHAR, ','
                       ORDER BY k) AS labels FROM ends GROUP BY pos) USING (pos)"""
)
def tk8_revision_stage_rows(spark, sf):
    pairs = revision_dataset(*revision_inputs(spark, sf))
    rows = revision_examples(pairs, vocabulary(spark, sf))
    return rows.select("pos", "valid", joined("ids").alias("ids"), joined("labels").alias("labels"))


@register(
    rf"""WITH p AS (SELECT doc_id, text, regexp_extract_all(text, '\s*(?:{TOKENS})') AS l FROM documents)
        SELECT doc_id, CASE WHEN len(l) <= 600 THEN text ELSE array_to_string(l[1:600], '') END AS prompt
        FROM p"""
)
def tk9_truncate_prompts(spark, sf):
    return truncate_prompts(
        table(spark, sf, "documents").select("doc_id", F.col("text").alias("prompt"))
    )


@register(
    """WITH p AS (SELECT d.doc_id, row_number() OVER (ORDER BY d.doc_id) - 1 AS pos,
              l.quality IS NOT NULL AS valid
            FROM documents d LEFT JOIN labels l USING (doc_id))
       SELECT (pos // 16)::BIGINT AS batch_id,
              (SELECT ceil(count(*) / 16.0)::BIGINT FROM p) AS n_batches, count(*) AS n_rows,
              string_agg(doc_id::VARCHAR, ',' ORDER BY pos) AS doc_ids
       FROM p WHERE valid GROUP BY 1"""
)
def tk10_make_batches(spark, sf):
    """Documents without a label are invalid: they use up a slot and vanish."""
    labels = table(spark, sf, "labels").select("doc_id", F.lit(True).alias("has"))
    docs = table(spark, sf, "documents").select("doc_id").join(labels, "doc_id", "left")
    rows = with_position(docs, "doc_id").select(
        "pos", "doc_id", F.col("has").isNotNull().alias("valid")
    )
    return make_batches(rows, 16).select(
        "batch_id", "n_batches", "n_rows",
        F.array_join(F.col("rows.doc_id").cast("array<string>"), ",").alias("doc_ids"),
    )


@register(
    """WITH e AS (SELECT unnest(range(3))::INT AS epoch),
       p AS (SELECT epoch, doc_id, row_number() OVER (PARTITION BY epoch
               ORDER BY md5('7|' || epoch || '|' || doc_id), doc_id) - 1 AS pos FROM documents, e)
       SELECT epoch, pos, (pos // 32)::BIGINT AS batch_id,
              (SELECT ceil(count(*) / 32.0)::BIGINT FROM documents) AS n_batches, doc_id FROM p"""
)
def tk11_epoch_plan(spark, sf):
    return epoch_plan(table(spark, sf, "documents"), "doc_id", 3, 32, seed=7)


_CUTS = (60, 300)
_LENGTHS = f"SELECT doc_id, len(regexp_extract_all(text, '{WORDS}')) AS n FROM documents"


@register(
    f"""WITH b AS (SELECT doc_id, CASE WHEN n <= {_CUTS[0]} THEN 0 WHEN n <= {_CUTS[1]} THEN 1 ELSE 2 END
                     AS stage_ord FROM ({_LENGTHS})),
        st AS (SELECT * FROM (VALUES (0, 'short', 13), (1, 'med', 8), (2, 'long', 5)) t(stage_ord, stage, epochs)),
        sz AS (SELECT stage_ord, ceil(count(*) / 32.0)::BIGINT AS n FROM b GROUP BY 1),
        fs AS (SELECT stage_ord, stage, n, epochs,
                 coalesce(sum(n * epochs) OVER (ORDER BY stage_ord ROWS BETWEEN UNBOUNDED PRECEDING
                   AND 1 PRECEDING), 0)::BIGINT AS first FROM sz JOIN st USING (stage_ord)),
        x AS (SELECT b.doc_id, fs.*, unnest(range(epochs))::INT AS epoch FROM b JOIN fs USING (stage_ord)),
        p AS (SELECT *, row_number() OVER (PARTITION BY stage_ord, epoch ORDER BY
                md5('7|' || stage_ord || '|' || epoch || '|' || doc_id), doc_id) - 1 AS pos FROM x)
        SELECT stage_ord, stage, epoch, (pos // 32)::BIGINT AS batch_id, pos,
               (first + epoch * n + pos // 32)::BIGINT AS global_batch, doc_id FROM p"""
)
def tk12_curriculum_plan(spark, sf):
    docs = difficulty_buckets(
        table(spark, sf, "documents"), F.size(split_words(F.col("text"))), cuts=_CUTS
    ).select("doc_id", "difficulty")
    docs = store(docs, "difficulty")  # read once per stage and pass
    data = {n: docs.where(F.col("difficulty") == n) for n, _ in V.STAGES}
    return curriculum_plan(data, "doc_id", 32, seed=7)


@register(
    f"""WITH l AS ({_LENGTHS}),
        q AS (SELECT quantile_disc(n, [1/3, 2/3]) AS q FROM l)
        SELECT doc_id, CASE WHEN n <= q[1] THEN 'short' WHEN n <= q[2] THEN 'med' ELSE 'long' END
          AS difficulty FROM l, q"""
)
def tk13_difficulty_buckets(spark, sf):
    return difficulty_buckets(
        table(spark, sf, "documents"), F.size(split_words(F.col("text")))
    ).select("doc_id", "difficulty")


@register(
    f"""SELECT doc_id, CASE WHEN n <= {_CUTS[0]} THEN 'short' WHEN n <= {_CUTS[1]} THEN 'med'
          ELSE 'long' END AS difficulty FROM ({_LENGTHS})"""
)
def tk13_difficulty_fixed_cuts(spark, sf):
    return difficulty_buckets(
        table(spark, sf, "documents"), F.size(split_words(F.col("text"))), cuts=_CUTS
    ).select("doc_id", "difficulty")


def _walk_sql(items: str, done: str) -> str:
    """Recursive CTEs that carry ``items(run, epoch, n, pos)`` round by round to ``done(run,
    epoch, n, pos, place)``; ``run`` is the seed's text.  The grid is searched in SQL."""
    hashed = f"((({{half}} + k) % {PRIME}) * {MIX} % {PRIME})"
    mixed = lambda half: f"((xor({hashed.format(half=half)}, {hashed.format(half=half)} >> 15) % {PRIME}) * (k + 1) % {PRIME})"
    return f"""
    sizes AS (SELECT DISTINCT n, greatest(floor(sqrt(n))::BIGINT, CASE WHEN n > 2 THEN 2 ELSE 1 END) AS f FROM {items}),
    tried AS (SELECT n, unnest(range(f, 4 * f + 1)) AS a FROM sizes),
    cells AS (SELECT n, arg_min(a, ((a - n % a) % a) * 100000 + a) AS a FROM tried GROUP BY n),
    started AS (SELECT i.*, a, (n + a - 1) // a AS b FROM {items} i JOIN cells USING (n)),
    walk AS (
      SELECT run, epoch, n, pos, a, b, pos // b AS l, pos % b AS r, 0 AS t FROM started
      UNION ALL
      SELECT run, epoch, n, pos, a, b,
        CASE WHEN t % 2 = 0 THEN (l + {mixed('r')} % a) % a ELSE l END,
        CASE WHEN t % 2 = 1 THEN (r + {mixed('l')} % b) % b ELSE r END, t + 1
      FROM (SELECT *, ('0x' || substr(md5(run || '|' || epoch || '|' || (t % {ROUNDS})), 1, 7))::BIGINT AS k FROM walk)
      WHERE t = 0 OR t % {ROUNDS} <> 0 OR l * b + r >= n),
    {done} AS (SELECT run, epoch, n, pos, l * b + r AS place FROM walk WHERE t > 0 AND t % {ROUNDS} = 0 AND l * b + r < n)"""


def _numbered(spark, sf):
    """Documents with stored positions, and their number."""
    rows = store(with_position(table(spark, sf, "documents").select("doc_id"), "doc_id"), "corpus")
    return rows, rows.count()


_PLACED = f"""WITH RECURSIVE numbered AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos, count(*) OVER () AS n FROM documents),
    items AS (SELECT '7' AS run, epoch, n, pos FROM numbered, (SELECT unnest(range(3))::INT AS epoch)),
    {_walk_sql('items', 'placed')}"""


@register(f"""{_PLACED} SELECT epoch, place::BIGINT AS place, (place // 32)::BIGINT AS batch_id, ((p.n + 31) // 32)::BIGINT AS n_batches, pos, doc_id
    FROM placed p JOIN numbered USING (pos)""")
def tk11_epoch_places(spark, sf):
    """The order of three epochs, computed row by row."""
    rows, n = _numbered(spark, sf)
    return epoch_places(rows.select("pos", "doc_id"), n, 3, 32, seed=7)


@register(f"""{_PLACED} SELECT (place // 32)::BIGINT AS batch_id, place::BIGINT AS place, pos FROM placed WHERE epoch = 2""")
def tk11_batch_positions(spark, sf):
    """All batches of the last epoch, from their places back to the positions."""
    _, n = _numbered(spark, sf)
    return batch_positions(spark, n, 2, 32, seed=7)


@register(
    f"""WITH RECURSIVE b AS (SELECT doc_id, CASE WHEN n_chars < 300 THEN 0 WHEN n_chars < 1000 THEN 1 ELSE 2 END AS stage_ord FROM documents),
    st AS (SELECT * FROM (VALUES (0, 'short', 3), (1, 'med', 2), (2, 'long', 1)) t(stage_ord, stage, epochs)),
    numbered AS (SELECT stage_ord, doc_id, row_number() OVER (PARTITION BY stage_ord ORDER BY doc_id) - 1 AS pos,
        count(*) OVER (PARTITION BY stage_ord) AS n FROM b),
    items AS (SELECT '7|' || stage_ord AS run, unnest(range(epochs))::INT AS epoch, n, pos FROM numbered JOIN st USING (stage_ord)),
    {_walk_sql('items', 'placed')},
    counts AS (SELECT stage_ord, stage, epochs, count(doc_id) AS n, ((count(doc_id) + 31) // 32) AS batches
        FROM st LEFT JOIN b USING (stage_ord) GROUP BY ALL),
    fs AS (SELECT *, coalesce(sum(batches * epochs) OVER (ORDER BY stage_ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM counts)
    SELECT fs.stage_ord, stage, epoch, place::BIGINT AS place, (place // 32)::BIGINT AS batch_id, batches::BIGINT AS n_batches,
        (start + epoch * batches + place // 32)::BIGINT AS global_batch, x.pos, doc_id
    FROM placed x JOIN numbered m ON x.run = '7|' || m.stage_ord AND x.pos = m.pos JOIN fs ON fs.stage_ord = m.stage_ord"""
)
def tk12_curriculum_places(spark, sf):
    docs = table(spark, sf, "documents")
    bounds = {"short": (0, 300, 3), "med": (300, 1000, 2), "long": (1000, None, 1)}
    data = {}
    for name, (low, high, epochs) in bounds.items():
        inside = F.col("n_chars") >= low
        rows = docs.where(inside & (F.col("n_chars") < high) if high else inside).select("doc_id")
        placed = store(with_position(rows, "doc_id"), f"stage_{name}").select("pos", "doc_id")
        data[name] = (placed, placed.count(), epochs)
    return curriculum_places(data, 32, seed=7)
