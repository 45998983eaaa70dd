"""Conversation tables.

A conversation is stored one row per turn (user_id, convo_id, turn, role,
text).  Every operator answers all users at once with windows keyed by
(user, conversation) or by user; the newest-n limits are ``row_number``
filters planned with a WindowGroupLimit before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_TITLE = "New Conversation"


def recent_messages(turns: DataFrame, cap: int = 100) -> DataFrame:
    """Keep the last ``cap`` messages of each conversation."""
    w = Window.partitionBy("user_id", "convo_id").orderBy(F.col("turn").desc())
    return turns.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") <= cap).drop("_rk")


def conversation_titles(turns: DataFrame, length: int = 50) -> DataFrame:
    """first user message's first ``length`` characters, else the default title."""
    first_user = F.min_by(F.col("text"), F.when(F.col("role") == "user", F.col("turn")))
    g = turns.groupBy("user_id", "convo_id").agg(first_user.alias("_t"))
    return g.select("user_id", "convo_id",
                    F.coalesce(F.substring("_t", 1, length), F.lit(DEFAULT_TITLE)).alias("title"))


def latest_active(convos: DataFrame) -> DataFrame:
    """Exactly one active conversation per user — the newest (largest id).

    The newest id per user is a partial aggregate (a user with a third of all
    conversations is reduced map side) joined back on the user id (AQE splits
    a skewed join partition).
    """
    newest = convos.groupBy("user_id").agg(F.max("convo_id").alias("_newest"))
    return (convos.join(newest, "user_id", "inner")
                  .withColumn("active", F.col("convo_id") == F.col("_newest")).drop("_newest"))


def activate(convos: DataFrame, choices: DataFrame) -> DataFrame:
    """For users in ``choices`` (user_id, convo_id or null = clear) exactly the chosen
    conversation is active (none when cleared); other users are unchanged."""
    ch = choices.select("user_id", F.col("convo_id").alias("_chosen"), F.lit(True).alias("_has"))
    j = convos.join(ch, "user_id", "left")
    act = F.when(F.col("_has"), F.coalesce(F.col("convo_id") == F.col("_chosen"), F.lit(False))) \
           .otherwise(F.col("active"))
    return j.withColumn("active", act).drop("_chosen", "_has")


def replay_history(saved: DataFrame) -> DataFrame:
    """user/assistant turns with non-empty text, in turn order, as one array per conversation.

    Everything saved is replayed; saving (X04, ``recent_messages``) has the cap,
    which bounds each collected array.
    """
    keep = saved.filter(F.col("role").isin("user", "assistant") & (F.length(F.coalesce("text", F.lit(""))) > 0))
    return keep.groupBy("user_id", "convo_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))),
                    lambda e: F.struct(e["role"].alias("role"), e["text"].alias("content"))).alias("messages"))


def conversation_list(convos: DataFrame, n: int = 20) -> DataFrame:
    """Newest ``n`` conversations per user (largest id first)."""
    w = Window.partitionBy("user_id").orderBy(F.col("convo_id").desc())
    return convos.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def conversations(turns: DataFrame) -> DataFrame:
    """Conversation header rows: title, message count, active flag."""
    t = conversation_titles(turns)
    n = turns.groupBy("user_id", "convo_id").agg(F.count(F.lit(1)).alias("n_messages"))
    return latest_active(t.join(n, ["user_id", "convo_id"], "inner"))
