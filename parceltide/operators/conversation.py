"""Conversation context: the latest messages before a question."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from parceltide import constants as K


def latest_messages(messages: DataFrame, n: int = K.CONTEXT_MESSAGES) -> DataFrame:
    """The last ``n`` messages per conversation. Spark limits the rank before the shuffle, so a
    very long conversation sends ``n`` rows per input partition."""
    latest = Window.partitionBy("conv_id").orderBy(F.col("turn").desc(), F.col("text").desc())
    return (
        messages.select("conv_id", "turn", "role", "text")
        .withColumn("nth", F.row_number().over(latest))
        .filter(F.col("nth") <= n)
    )


def chat_context(messages: DataFrame, n: int = K.CONTEXT_MESSAGES) -> DataFrame:
    """One row per conversation: its last ``n`` messages, oldest first, as ``role: text`` lines."""
    ordered = F.sort_array(F.collect_list(F.struct(-F.col("nth"), "role", "text")))
    lines = F.transform(ordered, lambda m: F.concat(m["role"], F.lit(": "), m["text"]))
    return latest_messages(messages, n).groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("messages"),
        F.array_join(lines, "\n").alias("context"),
    )
