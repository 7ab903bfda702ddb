"""String expressions: token splitting, seeded order keys, prompt texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tunesmith.fixed_values import END, REVISION_PIECES, SPECIALS

# a run of letters, a run of digits, or one other visible character
_RUNS, _OTHER = r"\p{L}+|\p{N}+", r"[^\s\p{L}\p{N}]"
WORD_PATTERN = f"{_RUNS}|{_OTHER}"


# Special tokens count as one token wherever they occur in a text.  All of them have
# the form <|name|>, so one literal prefix rules out nearly every position.
SPECIAL_PATTERN = r"<\|(?:" + "|".join(t[2:-2] for t in SPECIALS) + r")\|>"
TOKEN_PATTERN = f"{_RUNS}|{SPECIAL_PATTERN}|{_OTHER}"
# the same split, but every token keeps the white space in front of it
SPACED_PATTERN = r"\s*(?:" + TOKEN_PATTERN + ")"


def split_words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD_PATTERN), 0)


def split_tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), 0)


def order_hash(seed: int | str, *keys: Column) -> Column:
    """Hex digest that puts keys in a seeded, repeatable, shuffled order."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys]))


def truncate_to_tokens(text: Column, limit: int) -> Column:
    """``text`` if it has at most ``limit`` tokens, else its first ``limit``."""
    pieces = F.regexp_extract_all(text, F.lit(SPACED_PATTERN), 0)
    # a one-element array binds the split, so that it runs once per row
    cut = F.transform(
        F.array(pieces),
        lambda p: F.when(F.size(p) <= limit, text).otherwise(
            F.array_join(F.slice(p, 1, limit), "")
        ),
    )
    return cut[0]


def clean_completion(text: Column, stop: str = END) -> Column:
    """Cut at the first stop string, then drop special tokens."""
    return F.regexp_replace(F.substring_index(text, stop, 1), SPECIAL_PATTERN, "")


def revision_prompt(x: Column, c: Column, r_0: Column) -> Column:
    lead, before_reply, before_criterion, tail = (F.lit(p) for p in REVISION_PIECES)
    return F.concat(lead, x, before_reply, r_0, before_criterion, c, tail)


def text_or_none_word(value: Column) -> Column:
    """String form in which a missing value becomes the word ``None``."""
    return F.coalesce(value.cast("string"), F.lit("None"))


def last_number(raw: Column) -> Column:
    """The number behind the last ``:`` of a scorer's reply, null if unreadable."""
    field = F.element_at(F.split(F.trim(raw), ":"), -1)
    # a type letter behind the digits is no part of a number
    return F.when(~field.rlike(r"[0-9.][dDfF]\s*$"), field.try_cast("double"))


