"""Rewards of pending decisions as a stream: the state is what waits, a timer settles it.

A decision waits for the first session of its user on a later day. Rows may come in any order and late, up to the watermark, so the first
session that has come need not be the first there is: a decision is settled when the watermark has passed the earliest later session
seen, for no row at or before it can come any more. A decision without a session is settled without a reward when the
watermark has passed its expiry. Settled decisions and sessions that no decision can want leave the state, so it holds a few days of each active
user, however long the stream runs. Of decisions of one user and day the last by decided_at counts.
"""

from __future__ import annotations

import datetime as dt
from bisect import bisect_right
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
OUT = "user_id long, decision_date date, chosen_arm int, reward_session_date date, reward_amount double"
DAY_MS = 86_400_000
EPOCH = dt.date(1970, 1, 1)


def _ms(day: dt.date) -> int:
    return (day - EPOCH).days * DAY_MS


class PendingRewards(StatefulProcessor):
    """State of a user: decisions that wait, and sessions that may settle them, both by day, in one value with one timer.

    A call to the state is a round trip to the engine, so a user costs a few of them a batch, however many rows and days there are.
    """

    def __init__(self, expire_days: int) -> None:
        self.expire_ms = expire_days * DAY_MS

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "decision_days array<date>, decided_at array<long>, arms array<int>, session_days array<date>, rewards array<double>")

    def _load(self) -> tuple[dict, dict]:
        found = self.held.get()
        if found is None:
            return {}, {}
        days, at, arms, sessions, amounts = found
        return dict(zip(days, zip(at, arms))), dict(zip(sessions, amounts))

    def _store(self, decisions: dict, sessions: dict) -> None:
        """Keeps what is left, with a timer for the first moment at which some of it can go."""
        if not decisions and not sessions:
            self.held.clear()
            return
        self.held.update((list(decisions), [x[0] for x in decisions.values()], [x[1] for x in decisions.values()], list(sessions), list(sessions.values())))
        self.handle.registerTimer(min([*map(_ms, sessions), *(_ms(d) + self.expire_ms for d in decisions)]))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        decisions, sessions = self._load()
        for r in rows:
            if not r.is_decision:
                sessions[r.day] = r.reward
            elif r.day not in decisions or r.decided_at > decisions[r.day][0]:
                decisions[r.day] = (r.decided_at, r.chosen_arm)
        self._store(decisions, sessions)
        return iter(())

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        decisions, sessions = self._load()
        days = sorted(sessions)
        for day in sorted(decisions):
            at = bisect_right(days, day)
            if at < len(days) and _ms(days[at]) <= now:
                yield Row(user_id=key[0], decision_date=day, chosen_arm=decisions[day][1], reward_session_date=days[at], reward_amount=sessions[days[at]])
            elif _ms(day) + self.expire_ms <= now:
                yield Row(user_id=key[0], decision_date=day, chosen_arm=decisions[day][1], reward_session_date=None, reward_amount=None)
            else:
                continue
            del decisions[day]
        # Sessions up to now: decisions before them have come, and those that they settle are settled.
        self._store(decisions, {d: sessions[d] for d in days if _ms(d) > now})

    def close(self) -> None:
        pass


def settled_rewards(decisions: DataFrame, sessions: DataFrame, late: str = "3 days", expire_days: int = 30) -> DataFrame:
    """Stream of decisions with their rewards (columns of OUT), from streams of decisions (user_id, decision_date, decided_at, chosen_arm) and sessions (user_id, session_date, reward).

    Of equal session days the last reward that came counts. Rows that are later than ``late`` behind the newest day are left out.
    Sets the session's state store to the one that keeps timers.
    """
    decisions.sparkSession.conf.set(*STORE)
    left = decisions.select("user_id", F.col("decision_date").alias("day"), F.lit(True).alias("is_decision"), F.unix_micros(F.col("decided_at").cast("timestamp")).alias("decided_at"), F.col("chosen_arm").cast("int").alias("chosen_arm"), F.lit(None).cast("double").alias("reward"))
    right = sessions.select("user_id", F.col("session_date").alias("day"), F.lit(False).alias("is_decision"), F.lit(None).cast("long").alias("decided_at"), F.lit(None).cast("int").alias("chosen_arm"), F.col("reward").cast("double").alias("reward"))
    rows = left.unionByName(right).where("user_id IS NOT NULL AND day IS NOT NULL").withColumn("at", F.col("day").cast("timestamp")).withWatermark("at", late)
    return rows.groupBy("user_id").transformWithState(PendingRewards(expire_days), OUT, "Append", "EventTime")
