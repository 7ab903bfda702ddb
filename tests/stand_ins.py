"""Small deterministic stand-ins for models, for tests."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

from tunesmith.operators.inference import DecodeProfile, Generator
from tunesmith.operators.scoring import Scorer

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def letter_embedder():
    """Counts of the letters a-z as a vector."""

    def encode(texts: list[str]) -> list[list[float]]:
        return [[float(t.count(c)) for c in LETTERS] for t in texts]

    return encode


def echo_generator(profile: DecodeProfile) -> Generator:
    """Answers with the prompt, a stop string and trailing text behind it."""

    def generate(prompts: list[str]) -> list[str]:
        return [f"{profile.max_new_tokens}> {p}<|im_end|>tail" for p in prompts]

    return generate


def length_scorer() -> Scorer:
    """Scores a pair by the lengths of its texts; replies in ``name:number`` form."""

    def score(pairs: list[tuple[str, str]]) -> list[str]:
        return [f" reward:{(len(p) + len(r)) % 7} " for p, r in pairs]

    return score
