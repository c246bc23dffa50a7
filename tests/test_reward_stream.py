"""The stream of settled rewards against the batch as-of join, on shuffled micro-batches."""

import datetime as dt
import random

from pyspark.sql import functions as F

from lodestride.operators.decisions import reward_asof
from lodestride.streaming.daily import run_available
from lodestride.streaming.rewards import settled_rewards

DECISIONS, SESSIONS = "user_id long, decision_date date, decided_at timestamp, chosen_arm int", "user_id long, session_date date, reward double"


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(n)


def test_settled_rewards_equal_the_batch_join(spark, tmp_path):
    rng = random.Random(11)
    decisions, sessions = [], []
    for u in range(12):
        for d in range(25):
            if rng.random() < 0.5:
                for h in sorted(rng.sample(range(24), rng.choice([1, 1, 2]))):
                    decisions.append((u, day(d), dt.datetime(2024, 1, 1, h) + dt.timedelta(d), rng.randrange(5)))
            if rng.random() < 0.3 or (u == 3 and d < 2):
                sessions.append((u, day(d), round(rng.uniform(0, 9), 3)))
    # Batches go by day, but a row may be up to three days late; the last batch moves the watermark past every expiry.
    batches = {}
    for kind, rows, at in (("d", decisions, 1), ("s", sessions, 1)):
        for r in rows:
            batches.setdefault(((r[at] - day(0)).days + rng.randrange(4)) // 4, {"d": [], "s": []})[kind].append(r)
    streams = {}
    for kind, schema in (("d", DECISIONS), ("s", SESSIONS)):
        folder = str(tmp_path / kind)
        for i, b in enumerate([*(batches[k] for k in sorted(batches)), {"d": [(99, day(200), dt.datetime(2024, 9, 1), 0)], "s": [(99, day(199), 0.0)]}]):
            rng.shuffle(b[kind])
            spark.createDataFrame(b[kind], schema).coalesce(1).write.mode("append").parquet(folder)
        streams[kind] = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    out = []
    run_available(settled_rewards(streams["d"], streams["s"], late="8 days", expire_days=40), str(tmp_path / "c"), lambda df, i: out.extend(map(tuple, df.collect())))
    want = reward_asof(spark.createDataFrame(decisions, DECISIONS), spark.createDataFrame(sessions, SESSIONS))
    want = sorted(map(tuple, want.select("user_id", "decision_date", F.col("chosen_arm").cast("int"), "reward_session_date", "reward_amount").collect()), key=str)
    assert sorted(out, key=str) == want
    assert any(r[3] is None for r in want) and len(out) == len(set(x[:2] for x in out))
