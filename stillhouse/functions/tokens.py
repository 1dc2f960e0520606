"""Token counting, pluggable."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, functions as F, types as T

CHARS_PER_TOKEN = 4
# Fixed value: chat template tokens around a bare input.
CHAT_OVERHEAD = 10

TokenCounter = Callable[[Column], Column]


def estimated_tokens(text: Column) -> Column:
    """ceil(characters / 4), native."""
    return F.ceil(F.length(text).cast("double") / F.lit(float(CHARS_PER_TOKEN))).cast("bigint")


def encoder_tokens(make_encoder: Callable[[], Callable[[str], list[int]]]) -> TokenCounter:
    """Exact counts from an encoder, built once per Python worker batch stream."""
    cache: list = []

    @F.arrow_udf(T.LongType())
    def count(texts: pa.Array) -> pa.Array:
        if not cache:
            cache.append(make_encoder())
        encode = cache[0]
        return pa.array([None if t is None else len(encode(t)) for t in texts.to_pylist()], type=pa.int64())

    return count
