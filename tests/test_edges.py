"""Hand-worked rows per operator."""

import datetime as dt
import json
import math

import pytest
from pyspark.sql import functions as F

from tunesmith.functions.text import clean_completion, last_number, revision_prompt
from tunesmith.functions.tokenrows import labels_from_mask, mask_with_end
from tunesmith.operators.align import attach_criteria, rejoin_responses, unmatched, zip_join
from tunesmith.operators.batches import curriculum_plan, epoch_plan, make_batches, stages
from tunesmith.operators.chat import (
    extract_prompts,
    first_exchange,
    first_user_prompt,
    nest_messages,
    render_chat,
    render_each_turn,
    render_turns,
    to_exchange,
    unnest_messages,
    valid_preferences,
    zip_exchange,
)
from tunesmith.operators.criteria import assign_nearest, criteria_dataset, default_criteria
from tunesmith.operators.inference import batch_responses, read_reply_lines, reply_issues
from tunesmith.operators.losses import masked_nll, preference_loss
from tunesmith.operators.metrics import epoch_summary, running_loss, stage_summary
from tunesmith.operators.position import (
    head_n,
    range_split,
    seeded_prompts,
    seeded_sample,
    with_position,
    with_shuffled_position,
)
from tunesmith.operators.scoring import parse_rewards, rejected_rewards, reward_pairs, win_rate
from tunesmith.operators.tokens import (
    build_vocab,
    encode,
    encode_with,
    fit_length,
    revision_examples,
    sft_examples,
    truncate_prompts,
)
from tunesmith.sources import append_shards, read_completions, read_records
from tunesmith.streaming import metric_windows, read_metric_stream, run_available


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def conversation(spark, turns):
    data = [(c, i, r, t) for c, msgs in turns.items() for i, (r, t) in enumerate(msgs)]
    return spark.createDataFrame(data, "conv_id BIGINT, turn BIGINT, role STRING, text STRING")


CASES = {
    1: [("assistant", "a0"), ("user", "u1"), ("assistant", "a2")],
    2: [("user", "u0"), ("user", "u1"), ("assistant", "a2"), ("assistant", "a3")],
    3: [("system", "s")],
    4: [("assistant", "a0"), ("system", "s")],
    5: [("user", "u0"), ("user", "u1")],
    6: [("user", ""), ("assistant", "a1")],
    7: [("assistant", "a0"), ("user", "u1")],
    8: [("system", "s"), ("user", "u1"), ("assistant", "a2")],
}
EXCHANGES = {1: ("u1", "a2"), 2: ("u0", "a2"), 6: ("", "a1"), 8: ("u1", "a2")}


def test_first_exchange_cases(spark):
    turns = conversation(spark, CASES)
    assert rows(first_exchange(turns)) == sorted((k, *v) for k, v in EXCHANGES.items())
    flagged = {r.conv_id: tuple(r)[1:] for r in first_exchange(turns, "flag").collect()}
    assert flagged == {
        k: (*EXCHANGES[k], True) if k in EXCHANGES else (None, None, False) for k in CASES
    }


def test_first_exchange_with_one_huge_conversation(spark):
    """One conversation holds most rows and opens with an assistant."""
    base = spark.range(20_000).select(
        F.lit(0).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 15_000, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"),
    )
    turns = base.unionByName(conversation(spark, {k: v for k, v in CASES.items()}))
    got = {r.conv_id: (r.prompt, r.completion) for r in first_exchange(turns).collect()}
    assert got == {0: ("t15000", "t15001"), **EXCHANGES}


def test_first_exchange_with_many_assistant_openings(spark):
    """More such conversations than the small-set filter looks at."""
    n = 1_500
    data = [(c, i, r, f"{c}{r[0]}{i}") for c in range(n)
            for i, r in enumerate(("assistant", "user", "assistant"))]
    turns = spark.createDataFrame(data, "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    got = first_exchange(turns)
    assert got.count() == n
    assert got.where("completion = concat(conv_id, 'a2') AND prompt = concat(conv_id, 'u1')").count() == n


def test_first_user_prompt(spark):
    got = dict(rows(first_user_prompt(conversation(spark, CASES))))
    assert got == {1: "u1", 2: "u0", 3: None, 4: None, 5: "u0", 6: "", 7: "u1", 8: "u1"}
    assert len(rows(first_user_prompt(conversation(spark, CASES), keep_missing=False))) == 6


def test_nesting_keeps_turn_numbers(spark):
    data = [(1, t, "user" if t % 2 else "assistant", str(t)) for t in (0, 5, 4095, 4096, 10_000)]
    data += [(2, t, "user", str(t)) for t in range(10_000)]
    turns = spark.createDataFrame(data, "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    nested = nest_messages(turns)
    assert {r.conv_id: r.n for r in nested.select("conv_id", F.size("messages").alias("n")).collect()} == {1: 5, 2: 10_000}
    assert rows(unnest_messages(nested)) == rows(turns)
    assert dict(rows(extract_prompts(nested).select("conv_id", "prompt"))) == {1: "0", 2: "0"}
    texts = {}
    for r in render_each_turn(turns).orderBy("conv_id", "turn").collect():
        texts[r.conv_id] = texts.get(r.conv_id, "") + r.text
    assert texts == {r.conv_id: r.text for r in render_turns(turns).collect()}
    assert texts[1].count("<|im_start|>system") == 1


SYSTEM = "<|im_start|>system\nYou are a helpful assistant.<|im_end|>\n"


def test_render_cases(spark):
    turns = conversation(spark, {
        1: [("user", "hi"), ("assistant", "yo")],
        2: [("system", "S"), ("user", "hi")],
        3: [("user", "hi"), ("system", "S")],
    })
    got = {r.conv_id: r for r in render_turns(turns, add_generation_prompt=True).collect()}
    tail = "<|im_start|>assistant\n"
    assert got[1].text == SYSTEM + "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nyo<|im_end|>\n" + tail
    assert got[2].text == "<|im_start|>system\nS<|im_end|>\n<|im_start|>user\nhi<|im_end|>\n" + tail
    assert got[3].text == SYSTEM + "<|im_start|>user\nhi<|im_end|>\n<|im_start|>system\nS<|im_end|>\n" + tail
    assert [s.text for s in got[1].segments if s.generated] == ["yo"]


@pytest.mark.parametrize("labels", [True, False])
def test_render_parts(spark, labels):
    schema = "id INT, messages ARRAY<STRUCT<role: STRING, content: STRING, parts: ARRAY<STRUCT<kind: STRING, text: STRING>>>>"
    data = [(1, [("user", None, [("image", None), ("text", "look"), ("video", None)]),
                 ("assistant", "fine", None),
                 ("user", None, [("image_url", None), ("other", None)])])]
    got = render_chat(spark.createDataFrame(data, schema), add_vision_id=labels).first()
    p = (lambda s: s) if labels else (lambda s: "")
    img, vid = "<|vision_start|><|image_pad|><|vision_end|>", "<|vision_start|><|video_pad|><|vision_end|>"
    assert got.text == (
        SYSTEM + "<|im_start|>user\n" + p("Picture 1: ") + img + "look" + p("Video 1: ") + vid
        + "<|im_end|>\n<|im_start|>assistant\nfine<|im_end|>\n<|im_start|>user\n"
        + p("Picture 2: ") + img + "<|im_end|>\n"
    )
    assert [s.text for s in got.segments if s.generated] == ["fine"]


def test_two_message_conversations(spark):
    records = spark.createDataFrame([(0, "x", None), (1, None, "y")], "pos BIGINT, x STRING, y STRING")
    got = {r.pos: [tuple(m) for m in r.messages] for r in to_exchange(records).collect()}
    assert got == {0: [("user", "x"), ("assistant", "None")], 1: [("user", "None"), ("assistant", "y")]}
    prompts = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "pos BIGINT, prompt STRING")
    replies = spark.createDataFrame([(0, "A"), (1, None)], "pos BIGINT, completion STRING")
    zipped = zip_exchange(prompts, replies)
    assert zipped.count() == 2
    assert rows(extract_prompts(zipped).select("pos", "prompt")) == [(0, "a"), (1, "b")]
    assert rows(unmatched(prompts, replies)) == [(2, "left")]
    assert zip_join(prompts, replies).count() == 2


def test_valid_preferences(spark):
    m = ("user", "x")
    schema = "id INT, chosen ARRAY<STRUCT<role: STRING, content: STRING>>, rejected ARRAY<STRUCT<role: STRING, content: STRING>>"
    data = [(1, [m, m], [m, m]), (2, [m], [m, m]), (3, [m, m], [m, m, m]), (4, [m], [m])]
    assert [r.id for r in valid_preferences(spark.createDataFrame(data, schema)).collect()] == [1]


# --- positions -----------------------------------------------------------------------


@pytest.mark.parametrize("parts", [1, 7, 100])
@pytest.mark.parametrize("order", ["id % 3", "if(id % 3 = 0, 5L, id)", "1152921504606846976L + id % 3",
                                   "-id", "if(id % 2 = 0, null, id)", "cast(id % 7 as double) / 3"])
def test_positions_do_not_depend_on_buckets(spark, order, parts):
    df = spark.range(1000).repartition(5).withColumn("v", F.expr(order))
    got = {r.id: r.pos for r in with_position(df, "id", "v", parts=parts).collect()}
    vals = {r.id: r.v for r in df.collect()}
    key = lambda i: (vals[i] is not None, vals[i] if vals[i] is not None else 0, i)
    assert got == {k: n for n, k in enumerate(sorted(vals, key=key))}


def test_positions_by_group_and_empty(spark):
    df = spark.range(100).withColumn("g", F.when(F.col("id") < 70, 0).when(F.col("id") < 90, F.col("id") % 3))
    got = with_position(df.withColumn("other", F.lit("x")), "id", by=["g"], parts=9)
    assert got.count() == 100
    wrong = got.selectExpr("pos", "row_number() OVER (PARTITION BY g ORDER BY id) - 1 AS r").where("pos <> r")
    assert wrong.count() == 0
    assert with_position(spark.range(0), "id").count() == 0
    assert with_position(spark.range(0).withColumn("v", F.lit(1)), "id", "v").count() == 0


def test_positions_of_strings_and_structs(spark):
    df = spark.range(300).select(
        F.concat(F.lit("doc-"), F.col("id")).alias("name"), F.struct((F.col("id") % 7).alias("file"), F.col("id").alias("line")).alias("place"),
        F.lit("text").alias("text"),
    ).unionByName(spark.sql("SELECT CAST(NULL AS STRING) AS name, named_struct('file', 0L, 'line', -1L) AS place, 'text' AS text"))
    names = [r.name for r in with_position(df, "name", parts=9).orderBy("pos").collect()]
    assert names == [None, *sorted(f"doc-{i}" for i in range(300))]
    places = [tuple(r.place) for r in with_position(df, "place", parts=9).orderBy("pos").collect()]
    assert places == [(0, -1), *sorted((i % 7, i) for i in range(300))]


def test_shuffled_positions_are_a_permutation(spark):
    a = with_shuffled_position(spark.range(500).repartition(3), "id", 1)
    b = with_shuffled_position(spark.range(500).repartition(11), "id", 1, digits=1)
    assert rows(a) == rows(b)
    assert sorted(r.pos for r in a.collect()) == list(range(500))
    assert rows(a) != rows(with_shuffled_position(spark.range(500), "id", 2))


def test_splits_and_samples(spark):
    df = with_position(spark.range(10), "id")
    parts = range_split(df, {"train": (0, 4), "val": (4, None), "none": (3, 3)})
    assert [parts[k].count() for k in ("train", "val", "none")] == [4, 6, 0]
    assert head_n(df, 3).count() == 3 and head_n(df, None).count() == 10
    assert seeded_sample(df, "id", 99).count() == 10
    texts = df.withColumn("prompt", F.when(F.col("id") % 2 == 0, "").otherwise("p"))
    sample = {r.id for r in seeded_sample(df, "id", 6).collect()}
    assert {r.id for r in seeded_prompts(texts, "id", 6).collect()} == {i for i in sample if i % 2}


# --- sources -------------------------------------------------------------------------


def test_json_arrays(spark, tmp_path):
    files = {"a.json": ["s0", {"prompt": "p", "completion": "c1"}, None], "b.json": [], "c.json": ["s3"]}
    for name, value in files.items():
        (tmp_path / name).write_text(json.dumps(value, indent=2))
    assert read_completions(spark, str(tmp_path)).orderBy("pos").collect() == [
        (0, None, "s0"), (1, "p", "c1"), (2, None, None), (3, None, "s3")
    ]
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "x.json").write_text(json.dumps([{"x": f"q{i}", "y": "", "c": "k"} for i in range(5)]))
    assert rows(read_records(spark, str(tmp_path / "r"), 2)) == [(0, "q0", "", "k"), (1, "q1", "", "k")]


def test_append_shards(spark):
    one = spark.createDataFrame([(0, "a"), (1, "b")], "pos BIGINT, t STRING")
    two = spark.createDataFrame([(0, "c")], "pos BIGINT, t STRING")
    assert rows(append_shards([one, two])) == [(0, "a"), (1, "b"), (2, "c")]
    assert rows(append_shards([one, None])) == [(0, "a"), (1, "b")]


def test_reply_lines(spark, tmp_path):
    def line(i, text):
        return json.dumps({"custom_id": f"request-{i}", "response": {"body": {"choices": [{"message": {"role": "assistant", "content": text}}]}}})

    lines = [line(0, "first"), line(1, "one"), "{broken", line(0, "last"), json.dumps({"custom_id": "request-2", "response": None})]
    (tmp_path / "replies.jsonl").write_text("\n".join(lines) + "\n")
    got = read_reply_lines(spark, str(tmp_path))
    assert rows(batch_responses(got)) == [("request-0", "last"), ("request-1", "one")]
    prompts = spark.range(4).withColumnRenamed("id", "pos")
    assert {tuple(r) for r in reply_issues(prompts, got).collect()} == {
        ("missing", "request-2", 1), ("missing", "request-3", 1), ("repeated", "request-0", 2),
        ("unreadable", None, 1), ("unreadable", "request-2", 1),
    }


# --- categories -----------------------------------------------------------------------


def test_nearest_ties_and_zero_vectors(spark):
    means = spark.createDataFrame(
        [(0, "first", [1.0, 0.0]), (1, "twin", [2.0, 0.0]), (2, "up", [0.0, 1.0])],
        "ord INT, category STRING, vec ARRAY<DOUBLE>",
    )
    df = spark.createDataFrame([(1, [3.0, 0.0]), (2, [0.0, 0.0]), (3, [1.0, 2.0])], "id INT, embedding ARRAY<FLOAT>")
    got = {r.id: (r.category, round(r.similarity, 6)) for r in assign_nearest(df, means).collect()}
    assert got == {1: ("first", 1.0), 2: ("first", 0.0), 3: ("up", round(2 / math.sqrt(5), 6))}
    assert default_criteria(spark).count() == 8


def test_text_expressions(spark):
    df = spark.createDataFrame([("a<|im_end|>b", "x:1:2.5 "), ("<|pad|>c", "none"), ("", "3"), ("d", "a:nan")],
                               "t STRING, raw STRING")
    got = df.select(clean_completion(F.col("t")), last_number(F.col("raw"))).collect()
    assert [r[0] for r in got] == ["a", "c", "", "d"]
    assert [r[1] for r in got[:3]] == [2.5, None, 3.0] and math.isnan(got[3][1])
    assert df.select(last_number(F.lit("a:1.0d"))).first()[0] is None
    text = df.select(revision_prompt(F.lit("X"), F.lit("C"), F.lit("R"))).first()[0]
    assert "Instruction:\nX\n\nMy Initial Response:\nR\n\nCriteria: C\n\nMy initial" in text


# --- token rows ---------------------------------------------------------------------


def vocab_of(spark, text="a b c"):
    return build_vocab(spark.createDataFrame([(text,)], "text STRING"), 100)


def test_encoding_by_join_is_the_same(spark):
    vocab = build_vocab(spark.createDataFrame([("a b b c c c é",)], "text STRING"), None)
    assert [r.tok for r in vocab.orderBy("id").collect()] == ["c", "b", "a", "é"]
    segments = [[("<|im_start|>b zz", False), ("a <|im_end|>", True)], [(None, False), ("", True)], [], [("c " * 500, True)]]
    df = spark.createDataFrame(list(enumerate(segments)), "id INT, segments ARRAY<STRUCT<text STRING, generated BOOLEAN>>")
    assert rows(encode(df, vocab, by_join=True)) == rows(encode(df, vocab, by_join=False))


@pytest.mark.parametrize("ids,gen,mask", [
    ([1, 5, 2, 1, 6, 2], [0, 0, 0, 0, 1, 0], [0, 0, 0, 0, 1, 1]),
    ([1, 5, 2, 1], [0, 0, 0, 0], [0, 0, 1, 0]),
    ([5, 6], [0, 1], [0, 1]),
    ([2], [0], [1]),
    ([], [], []),
])
def test_mask_with_end(spark, ids, gen, mask):
    df = spark.createDataFrame([(ids, gen)], "ids ARRAY<INT>, generated ARRAY<INT>")
    row = df.select(mask_with_end(F.col("ids"), F.col("generated")).alias("m"), "ids")
    assert row.first().m == mask
    labels = row.select(labels_from_mask(F.col("ids"), F.col("m"))).first()[0]
    assert labels == [t if m else -100 for t, m in zip(ids, mask)]


def test_encode_knows_special_and_unknown_tokens(spark):
    df = spark.createDataFrame([([("<|im_start|>b zz", False), ("a<|im_end|>", True), ("<|pad|>", False)],)],
                               "segments ARRAY<STRUCT<text: STRING, generated: BOOLEAN>>")
    got = encode(df, vocab_of(spark)).first()
    assert (got.ids, got.generated) == ([1, 5, 3, 4, 2, 0], [0, 0, 0, 1, 1, 0])


@pytest.mark.parametrize("extra", [-1, 0, 1])
def test_length_policies(spark, extra):
    df = spark.createDataFrame([(list(range(10 + extra)), [0] * (10 + extra))], "ids ARRAY<INT>, generated ARRAY<INT>")
    assert fit_length(df, 10, "drop").count() == (1 if extra <= 0 else 0)
    assert len(fit_length(df, 10, "truncate").first().ids) == min(10, 10 + extra)


def test_examples_keep_or_drop(spark):
    turns = conversation(spark, {1: [("user", "a"), ("assistant", "b")], 2: [("user", "a " * 30), ("assistant", "b")], 3: [("user", "a")]})
    vocab = vocab_of(spark)
    assert [r.conv_id for r in sft_examples(turns, vocab, length=20).collect()] == [1]
    got = {r.conv_id: r for r in revision_examples(first_exchange(turns, "flag"), vocab, "conv_id", 20).collect()}
    assert {k: r.valid for k, r in got.items()} == {1: True, 2: False, 3: False}
    assert got[2].ids == [] and got[1].labels[-1] == 2
    assert [x for x in got[1].labels if x != -100] == [5, 2]


def test_truncate_prompts(spark):
    words = [f"w{i}," for i in range(300)]  # three tokens each: w, digits, comma
    df = spark.createDataFrame([("  ".join(words[:200]),), ("  ".join(words[:200]) + " x  ",)], "prompt STRING")
    got = [r.prompt for r in truncate_prompts(df).collect()]
    assert got[0] == "  ".join(words[:200]) == got[1]


def test_outside_tokenizer(spark):
    df = spark.createDataFrame([("ab",), (None,)], "text STRING")
    got = encode_with(df, lambda: lambda texts: [[ord(c) for c in t] for t in texts]).collect()
    assert [r.ids for r in got] == [[97, 98], []]


# --- batches ------------------------------------------------------------------------


def test_batch_slots(spark):
    data = [(i, i not in (2, 3, 6)) for i in range(7)]
    got = make_batches(spark.createDataFrame(data, "pos BIGINT, valid BOOLEAN"), 2)
    assert rows(got.select("batch_id", "n_batches", "n_rows")) == [(0, 4, 2), (2, 4, 2)]


def test_epoch_and_curriculum_plans(spark):
    plan = epoch_plan(spark.range(10), "id", epochs=2, batch_size=4, seed=3)
    assert rows(plan.groupBy("epoch").agg(F.count_distinct("id"), F.max("batch_id"), F.max("n_batches"))) == [
        (0, 10, 2, 3), (1, 10, 2, 3)
    ]
    order = [[r.id for r in plan.where(f"epoch = {e}").orderBy("pos").collect()] for e in (0, 1)]
    assert order[0] != order[1]
    data = {"short": spark.range(3), "med": spark.range(5), "long": spark.range(2)}
    full = curriculum_plan(data, "id", 2, stages("all", epochs=2))
    assert sorted({r.global_batch for r in full.collect()}) == list(range(2 * (2 + 3 + 1)))
    assert [(s.name, s.epochs) for s in stages()] == [("short", 13), ("med", 8), ("long", 5)]
    assert [(s.name, s.epochs) for s in stages("med")] == [("med", 8)]


# --- scores and losses ----------------------------------------------------------------


def test_win_rate_rules(spark):
    data = [(2.0, 1.0), (1.0, 1.0), (0.0, 1.0), (None, 5.0), (float("nan"), 1.0)]
    df = spark.createDataFrame(data, "reward_a DOUBLE, reward_b DOUBLE")
    strict, ties = win_rate(df).first(), win_rate(df, True).first()
    assert (strict.n_prompts, strict.n_wins, strict.win_rate) == (5, 1, 0.2)
    assert (ties.n_wins, ties.win_rate) == (2, 0.4)
    swapped = df.where("reward_a IS NOT NULL AND NOT isnan(reward_a)")
    other = swapped.select(F.col("reward_b").alias("reward_a"), F.col("reward_a").alias("reward_b"))
    assert win_rate(swapped).first().win_rate + win_rate(other, True).first().win_rate == pytest.approx(1)
    empty = win_rate(df.limit(0)).first()
    assert (empty.n_prompts, empty.win_rate, empty.mean_a) == (0, None, None)


def test_rewards(spark):
    df = spark.createDataFrame([("reward:-1.5",), ("7",), ("oops",), (None,)], "raw STRING")
    assert [r.reward for r in parse_rewards(df).collect()] == [-1.5, 7.0, None, None]
    assert [r.raw for r in rejected_rewards(parse_rewards(df)).collect()] == ["oops"]


def test_preference_loss_on_a_grid(spark):
    beta, length = 0.5, 4
    cells = {  # example -> position -> (policy chosen, ref chosen, policy rejected, ref rejected)
        1: {0: (-1.0, -2.0, -3.0, -1.0), 1: (-0.5, -0.25, 0.0, 0.0), 2: (0.0, 0.0, -4000.0, 0.0)},
        2: {1: (0.0, 0.0, 0.0, -5000.0)},
        3: {},
    }
    data = []
    for ex, cols in cells.items():
        for pos, values in cols.items():
            names = [(s, m) for s in ("chosen", "rejected") for m in ("policy", "reference")]
            data += [(ex, s, m, pos, v) for (s, m), v in zip(names, values) if v]
    logps = spark.createDataFrame(data, "example_id INT, side STRING, model STRING, pos INT, logp DOUBLE")
    examples = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "example_id INT, batch_id INT")

    def nls(z):
        return math.log1p(math.exp(-abs(z))) + max(-z, 0)

    def z(ex, pos):
        a, b, c, d = cells[ex].get(pos, (0, 0, 0, 0))
        return beta * ((a - b) - (c - d))

    want = {0: sum(nls(z(e, p)) for e in (1, 2) for p in range(length)) / (2 * length), 1: math.log(2)}
    got = {r.batch_id: r.loss for r in preference_loss(logps, examples, beta, length).collect()}
    assert got == {k: pytest.approx(v, abs=1e-9) for k, v in want.items()}
    seq = {r.batch_id: r.loss for r in preference_loss(logps, examples, beta, reduce="sequence").collect()}
    assert seq[0] == pytest.approx(sum(nls(sum(z(e, p) for p in range(length))) for e in (1, 2)) / 2)


def test_masked_nll(spark):
    df = spark.createDataFrame([(0, 5, -1.0), (0, -100, -9.0), (0, 6, -2.0), (1, -100, -1.0)], "batch_id INT, label INT, logp DOUBLE")
    assert rows(masked_nll(df)) == [(0, 1.5, 2)]


# --- metrics ------------------------------------------------------------------------


def log_of(spark, losses):
    data = [("r", e, i, v, u) for e, series in losses.items() for i, (v, u) in enumerate(series)]
    return spark.createDataFrame(data, "run_id STRING, epoch INT, i BIGINT, loss DOUBLE, used BOOLEAN")


@pytest.mark.parametrize("chunk", [1, 2, 100])
def test_running_loss(spark, chunk):
    log = log_of(spark, {0: [(9.0, False), (2.0, True), (4.0, True), (float("nan"), True), (6.0, True)], 1: [(5.0, True)]})
    seen = rows(running_loss(log, "seen", skip_nan=True, chunk=chunk).select("epoch", "i", "step", "avg_loss"))
    assert seen == [(0, 1, 1, 1.0), (0, 2, 2, 2.0), (0, 4, 4, 12 / 5), (1, 0, 1, 5.0)]
    used = rows(running_loss(log, "used", every=2, skip_nan=True, chunk=chunk).select("epoch", "i", "avg_loss"))
    assert used == [(0, 2, 3.0), (0, 4, 4.0)]


def test_epoch_and_stage_summaries(spark):
    log = log_of(spark, {0: [(2.0, True), (4.0, False), (4.0, True)], 1: [(1.0, False)]}).withColumn("phase", F.lit("train"))
    assert rows(epoch_summary(log).select("epoch", "loss")) == [(0, 2.0), (1, 0.0)]
    assert {tuple(r) for r in epoch_summary(log, "used").select("epoch", "loss").collect()} == {(0, 3.0), (1, None)}
    data = [("r", "short", e, p, v) for e, p, v in [(0, "train", 3.0), (1, "train", 2.0), (0, "val", 5.0)]]
    df = spark.createDataFrame(data, "run_id STRING, stage STRING, epoch INT, phase STRING, loss DOUBLE")
    assert rows(stage_summary(df)) == [("r", "short", 2.0, 5.0)]


def test_metric_stream_drops_late_and_holds_open(spark, tmp_path):
    schema = "run_id STRING, tag STRING, step BIGINT, value DOUBLE, ts TIMESTAMP"

    def points(*hours):
        return spark.createDataFrame([("r", "loss", i, float(h), dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)) for i, h in enumerate(hours)], schema)

    source, folder = str(tmp_path / "in"), str(tmp_path / "state")
    out = str(tmp_path / "out")

    def drain():
        stream = metric_windows(read_metric_stream(spark, source, points(0).schema), "1 day", "1 hour")
        return run_available(stream, out, folder)

    points(1, 2, 30).write.mode("append").parquet(source)
    assert rows(drain().select("n", "mean")) == [(2, 1.5)]
    points(3, 60).write.mode("append").parquet(source)  # 3 is too late, 60 closes day two
    assert rows(drain().select("n", "mean")) == [(1, 30.0), (2, 1.5)]


def test_outside_scorer_is_called_once_per_pair(spark):
    calls = spark.sparkContext.accumulator(0)

    def score(pairs):
        def run(batches):
            for frame in batches:
                calls.add(len(frame))
                yield frame.assign(reward=frame["response"].str.len().astype("float64"))

        return pairs.mapInPandas(run, pairs.withColumn("reward", F.lit(0.0)).schema)

    prompts = spark.createDataFrame([(i, f"p{i}", "g") for i in range(4)], "prompt_id BIGINT, prompt STRING, lang STRING")
    a = spark.createDataFrame([(i, "aa") for i in range(4)], "prompt_id BIGINT, completion STRING")
    b = spark.createDataFrame([(i, "b" * i) for i in range(3)], "prompt_id BIGINT, completion STRING")
    pairs = reward_pairs(prompts, a, b, score)
    got = sorted((r.prompt_id, r.lang, r.reward_a, r.reward_b) for r in pairs.collect())
    assert got == [(0, "g", 2.0, 0.0), (1, "g", 2.0, 1.0), (2, "g", 2.0, 2.0), (3, "g", 2.0, None)]
    assert win_rate(pairs).first().n_wins == 2
    assert calls.value == 7


def test_criteria_ride_with_the_means(spark):
    means = spark.createDataFrame([(0, "A", [1.0, 0.0]), (1, "Z", [0.0, 1.0])], "ord INT, category STRING, vec ARRAY<DOUBLE>")
    criteria = spark.createDataFrame([("A", "be A")], "category STRING, criterion STRING")
    prompts = spark.createDataFrame([(0, "x", [2.0, 0.1])], "pos BIGINT, prompt STRING, embedding ARRAY<DOUBLE>")
    assert rows(criteria_dataset(prompts, means, criteria)) == [(0, "x", "", "be A")]
    lost = prompts.withColumn("embedding", F.array(F.lit(0.0), F.lit(1.0)))
    with pytest.raises(Exception, match="no criterion for Z"):
        criteria_dataset(lost, means, criteria).collect()


def test_exact_keys_are_required(spark):
    df = spark.createDataFrame([("a", 0), ("b", 1)], "category STRING, pos BIGINT")
    criteria = spark.createDataFrame([("a", "be a")], "category STRING, criterion STRING")
    with pytest.raises(Exception, match="no criterion for b"):
        attach_criteria(df, criteria).count()
    assert attach_criteria(df, criteria, on_missing="drop").count() == 1
    replies = spark.createDataFrame([("request-1", "x")], "custom_id STRING, content STRING")
    with pytest.raises(Exception, match="no reply for request-0"):
        rejoin_responses(df, replies).count()
    assert rows(rejoin_responses(df, replies, on_missing="drop").select("pos", "content")) == [(1, "x")]


def test_positions_behind_the_grid_do_not_count(spark):
    cells = [(1, side, model, pos, -1.0 if (side, model) == ("chosen", "policy") else 0.0)
             for side in ("chosen", "rejected") for model in ("policy", "reference") for pos in range(8)]
    logps = spark.createDataFrame(cells, "example_id INT, side STRING, model STRING, pos INT, logp DOUBLE")
    examples = spark.createDataFrame([(1, 0)], "example_id INT, batch_id INT")
    loss = preference_loss(logps, examples, beta=0.5, length=2).first().loss
    assert abs(loss - 0.9740769841801067) < 1e-12
