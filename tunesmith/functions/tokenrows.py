"""Expressions on token arrays: masks, labels, length policies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tunesmith.fixed_values import END_ID, IGNORE_LABEL, PAD_ID


def ints(array: Column) -> Column:
    return array.cast("array<int>")


def mask_with_end(ids: Column, generated: Column, end_id: int = END_ID) -> Column:
    """The generated-mask with the last end token switched on as well.

    After truncation the last end token may close a user or system turn; that is
    kept.  A row without any end token keeps its mask unchanged.
    """
    from_back = F.array_position(F.reverse(ids), end_id).cast("int")  # 1-based, 0 = none
    before = F.size(ids) - from_back
    # spliced, not transformed: inside a lambda the search would run per element
    spliced = F.concat(
        F.slice(generated, 1, before),
        F.array(F.lit(1)),
        F.slice(generated, before + 2, F.size(ids)),
    )
    return F.when(from_back > 0, spliced).otherwise(generated)


def labels_from_mask(ids: Column, mask: Column) -> Column:
    return ints(F.zip_with(ids, mask, lambda t, m: F.when(m == 1, t).otherwise(IGNORE_LABEL)))


def padded(array: Column, length: int, value: int) -> Column:
    missing = F.greatest(F.lit(length) - F.size(array), F.lit(0))
    return ints(F.concat(F.slice(array, 1, length), F.array_repeat(F.lit(value), missing)))


def padded_ids(ids: Column, length: int) -> Column:
    return padded(ids, length, PAD_ID)


def attention(ids: Column, length: int) -> Column:
    """1 for each real token, 0 for padding."""
    return padded(F.transform(ids, lambda _: F.lit(1)), length, 0)
