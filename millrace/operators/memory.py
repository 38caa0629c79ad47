"""Conversation memory: the last messages of a session, with expiry and a character budget."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import running_totals
from millrace.operators.select import newest_per_key


def live_messages(df: DataFrame, session: str, turn: str, ts: str, now: str, keep: int = 20, ttl_hours: int = 24) -> DataFrame:
    """The newest ``keep`` messages of every session whose last write is no older than the TTL."""
    alive = df.groupBy(session).agg(F.max(ts).alias("__last")).filter(
        F.col("__last") >= F.lit(now).cast("timestamp") - F.expr(f"interval {ttl_hours} hours")
    )
    kept = newest_per_key(df, [session], [F.col(ts).desc(), F.col(turn).desc()], keep)
    return kept.join(alive.select(session), session, "left_semi")


def session_context(messages: DataFrame, session: str, turn: str, terms: str, last: int = 5) -> DataFrame:
    """Number of messages and the distinct terms of the last ``last`` of them."""
    recent = newest_per_key(messages, [session], [F.col(turn).desc()], last)
    seen = recent.select(session, F.explode(terms).alias("t")).distinct().groupBy(session).agg(F.array_sort(F.collect_list("t")).alias("terms"))
    sizes = messages.groupBy(session).agg(F.count(F.lit(1)).alias("messages"))
    return sizes.join(seen, session, "left").withColumn("terms", F.coalesce("terms", F.array().cast("array<string>")))


def prompt_history(df: DataFrame, session: str, turn: str, role: str, text: str, max_tokens: int = 2000) -> DataFrame:
    """Newest lines that fit in ``4 * max_tokens`` characters, back in order, one per line.

    Walks from the newest and stops at the first line that would not fit; line breaks are not
    counted. The running length comes from bucketed totals, so a session of any size is split.
    """
    limit = 4 * max_tokens
    line = F.concat(F.initcap(F.col(role)), F.lit(": "), F.col(text))
    lines = df.select(session, turn, line.alias("__line"), F.length(line).cast("long").alias("__size"))
    fits = running_totals(lines, [session], turn, {"__newer": "__size"}, descending=True).filter(F.col("__newer") + F.col("__size") <= limit)
    ordered = F.array_sort(F.collect_list(F.struct(F.col(turn).alias("t"), F.col("__line").alias("l"))))
    return fits.groupBy(session).agg(F.array_join(F.transform(ordered, lambda x: x["l"]), "\n").alias("history"), F.count(F.lit(1)).alias("lines"))
