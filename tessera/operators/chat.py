"""Chat records from turn rows, and back.

A thread is one entry (one row), as in the corpus files. Assembly is one
hash aggregation on the thread id; flattening is a generator, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.chat import json_string

# Fixed framing of a canonical line: '{"messages": [' + messages joined by
# ', ' + ']}'; one message is '{"role": ' + role + ', "content": ' + text + '}'.
_LINE_OPEN, _LINE_CLOSE, _MESSAGE_SEP = '{"messages": [', ']}', ', '


def assemble(turns: DataFrame, thread: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text") -> DataFrame:
    """``(thread, messages)`` with messages in turn order."""
    agg = turns.groupBy(thread).agg(
        F.array_sort(F.collect_list(F.struct(F.col(turn).alias("t"), F.col(role).alias("role"),
                                             F.col(text).alias("content")))).alias("_m"))
    return agg.select(thread, F.transform("_m", lambda m: F.struct(
        m.getField("role").alias("role"), m.getField("content").alias("content"))).alias("messages"))


def flatten(entries: DataFrame, thread: str = "conv_id") -> DataFrame:
    """One row per message: ``(thread, turn, role, text)``, turn from 0."""
    return entries.select(thread, F.posexplode("messages").alias("turn", "m")).select(
        thread, F.col("turn").cast("bigint").alias("turn"),
        F.col("m.role").alias("role"), F.col("m.content").alias("text"))


def thread_measures(turns: DataFrame, thread: str = "conv_id", turn: str = "turn",
                    role: str = "role", text: str = "text") -> DataFrame:
    """Per thread, without assembling it: ``chars`` (characters of every
    message), ``line_bytes`` (UTF-8 bytes of its canonical line and the
    newline) and ``first_role`` (role of the lowest turn).

    Every measure is a sum or a ``min_by`` over the turn rows, so the
    aggregation is partial before the exchange: a thread with very many
    turns reaches the shuffle as one row per task, and no message array is
    built.
    """
    message = F.concat(F.lit('{"role": '), json_string(F.col(role)), F.lit(', "content": '),
                       json_string(F.col(text)), F.lit("}"))
    agg = turns.groupBy(thread).agg(
        F.count(F.lit(1)).alias("_k"),
        F.sum(F.coalesce(F.length(text), F.lit(0)).cast("bigint")).alias("chars"),
        F.sum(F.octet_length(message).cast("bigint")).alias("_mb"),
        F.min_by(F.col(role), F.col(turn)).alias("first_role"))
    frame = len((_LINE_OPEN + _LINE_CLOSE).encode("utf-8")) + 1  # + newline
    sep = len(_MESSAGE_SEP.encode("utf-8"))
    return agg.select(thread, "chars", "first_role",
                      (F.lit(frame) + F.col("_mb") + F.lit(sep) * (F.col("_k") - 1))
                      .cast("bigint").alias("line_bytes"))
