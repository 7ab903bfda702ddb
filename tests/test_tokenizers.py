"""Outside tokenizers: tokens against the generated stretches of the text."""

import random

import pytest
from pyspark.sql import functions as F

from tunesmith.functions.tokenizers import OutsideTokenizer, byte_ranks, hashing_tokenizer, tokenizer_file
from tunesmith.operators.chat import render_chat
from tunesmith.operators.tokens import encode, overlaps, pad_examples, pad_preferences, preference_examples, revision_examples, sft_examples

FILES = "/opt/tokenizers"
MARKS = ("<|im_start|>", "<|im_end|>")


def test_overlaps_brute_force():
    rng = random.Random(0)
    for _ in range(300):
        sizes = [rng.choice([0, 1, 2, 5]) for _ in range(rng.randint(0, 8))]
        flags = [rng.random() < 0.5 for _ in sizes]
        total, spans, at = sum(sizes), [], 0
        while at < total:  # gaps, empty tokens, several tokens on one character
            end = min(total, at + rng.choice([0, 1, 1, 3]))
            spans += [(at, end)] * rng.choice([1, 1, 2])
            at = end + (rng.random() < 0.2)
        made = [i for i, f in enumerate(f for f, n in zip(flags, sizes) for _ in range(n)) if f]
        want = [int(any(a <= i < b for i in made)) for a, b in spans]
        assert overlaps(spans, sizes, flags) == want, (spans, sizes, flags)


def chats(spark):
    rows = [
        (1, "Hé ünd 你好?", "Ça va 🙂 bien<ok>"), (2, "q", "é"), (3, "", "a"), (4, "what < this", "x " * 300), (5, "ok\n", "\n\nyes\n"),
    ]
    return spark.createDataFrame(rows, "conv_id long, prompt string, completion string")


def tokenizers():
    import public_tokenizers as public

    own = tokenizer_file(f"{FILES}/byte_bpe_50k.json", 50258, 50256, MARKS)
    ranks = byte_ranks(f"{FILES}/byte_bpe_50k.tiktoken", public.PATTERN, 50258, 50256, {MARKS[0]: 50257, MARKS[1]: 50258})
    return {"chars": own, "bytes": ranks, "hash": hashing_tokenizer()}


@pytest.mark.parametrize("kind", ["chars", "bytes", "hash"])
def test_labels_are_the_reply_and_the_last_end(spark, kind):
    tokenizer = tokenizers()[kind]
    rows = revision_examples(chats(spark), tokenizer, "conv_id", 4096).collect()
    encoder = tokenizer.loader()
    for r, (key, prompt, completion) in zip(sorted(rows), chats(spark).collect()):
        lead = f"<|im_start|>system\nYou are a helpful assistant.<|im_end|>\n<|im_start|>user\n{prompt}<|im_end|>\n<|im_start|>assistant\n"
        text = lead + completion + "<|im_end|>\n"
        ids, spans = encoder([text])[0]
        a, b = len(lead), len(lead + completion)
        if tokenizer.unit == "bytes":
            a, b = len(lead.encode()), len((lead + completion).encode())
        last = max(i for i, t in enumerate(ids) if t == tokenizer.end_id)
        assert r.ids == ids and r.valid
        assert [x != -100 for x in r.labels] == [(s < b and e > a and s < e) or i == last for i, (s, e) in enumerate(spans)]
        assert all(x in (-100, t) for x, t in zip(r.labels, ids))


def test_a_character_of_several_tokens_is_generated_whole(spark):
    chat = spark.createDataFrame([(1, [("a", False), ("🙂", True), ("b", False)])], "k long, segments array<struct<text: string, generated: boolean>>")
    for kind in ("chars", "bytes"):
        r = encode(chat, tokenizers()[kind]).first()
        assert len(r.ids) > 3 and r.generated == [0, *[1] * (len(r.ids) - 2), 0]


def test_rows_of_all_stages(spark):
    tokenizer = tokenizers()["chars"]
    turns = spark.createDataFrame(
        [(1, 0, "user", "hi"), (1, 1, "assistant", "there 🙂"), (2, 0, "user", "x"), (3, 0, "user", "long"), (3, 1, "assistant", "z " * 900)],
        "conv_id long, turn long, role string, text string",
    )
    sft = sft_examples(turns, tokenizer)
    assert [r.conv_id for r in sft.collect()] == [1]  # without a reply, and too long
    padded = pad_examples(sft, 64, tokenizer.pad_id).first()
    assert padded.input_ids[-1] == 50256 and padded.labels[-1] == -100 and sum(padded.attention_mask) < 64
    message = "array<struct<role: string, content: string>>"
    sides = spark.createDataFrame(
        [(1, [("user", "q"), ("assistant", "good é")], [("user", "q"), ("assistant", "bad")]), (2, [("user", "q")], [("user", "q"), ("assistant", "b")])],
        f"conv_id long, chosen {message}, rejected {message}",
    )
    rows = preference_examples(sides, tokenizer)
    r = pad_preferences(rows, 64, tokenizer.pad_id).first()
    assert rows.count() == 1 and r.chosen_input_ids[-1] == 50256 and sum(r.chosen_assistant_masks) > sum(r.rejected_assistant_masks) > 1


def test_null_and_empty_segments(spark):
    kind = "k long, segments array<struct<text: string, generated: boolean>>"
    chat = spark.createDataFrame([(1, []), (2, None), (3, [(None, True), ("ab", True)]), (4, [("ab", None)])], kind)
    got = {r.k: (len(r.ids), r.generated) for r in encode(chat, hashing_tokenizer()).collect()}
    assert got == {1: (0, []), 2: (0, []), 3: (1, [1]), 4: (1, [0])}
    with pytest.raises(ValueError):
        OutsideTokenizer(list, 0, 0, "words")


def test_encoding_is_a_narrow_map(spark):
    plan = encode(render_chat(chats(spark).select("conv_id", F.expr("array(struct('user' AS role, prompt AS content))").alias("messages"))), hashing_tokenizer())
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and text.count("ArrowEvalPython") == 1
