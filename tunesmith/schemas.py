"""Declared schemas of the tables that move between jobs."""

from __future__ import annotations

from pyspark.sql import types as T

MESSAGE = T.StructType(
    [T.StructField("role", T.StringType()), T.StructField("content", T.StringType())]
)
MESSAGES = T.ArrayType(MESSAGE)

# long form of a chat corpus, the storage model
TURNS = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)

PROMPTS = T.StructType([T.StructField("prompt", T.StringType())])

RECORDS = T.StructType(
    [
        T.StructField("pos", T.LongType()),
        T.StructField("x", T.StringType()),
        T.StructField("y", T.StringType()),
        T.StructField("c", T.StringType()),
    ]
)

METRICS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("tag", T.StringType()),
        T.StructField("step", T.LongType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("ts", T.TimestampType()),
    ]
)

# one line of a batch-inference reply file
REPLY = T.StructType(
    [
        T.StructField("custom_id", T.StringType()),
        T.StructField(
            "response",
            T.StructType(
                [
                    T.StructField(
                        "body",
                        T.StructType(
                            [
                                T.StructField(
                                    "choices",
                                    T.ArrayType(
                                        T.StructType([T.StructField("message", MESSAGE)])
                                    ),
                                )
                            ]
                        ),
                    )
                ]
            ),
        ),
    ]
)
