"""Keyed state across batches against the batch operators."""

import datetime as dt
import json
import random

from pyspark.sql import functions as F

from catalogflow.operators import logs
from catalogflow.streaming.jobs import read_files
from catalogflow.streaming import state
from catalogflow.streaming.state import follow_assets, followed, start_following

SCHEMA = "asset long, status string, at timestamp, ord long"


def test_batches_equal_the_whole_log(spark, tmp_path):
    rng = random.Random(7)
    start = dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc)
    log = [{"asset": rng.randrange(8), "status": rng.choice(["e", "e", "v", "ok", None]), "at": start + dt.timedelta(minutes=i + rng.random()), "ord": i} for i in range(180)]
    # the end moves the watermark past all records
    ends = [{"asset": 99, "status": "ok", "at": start + dt.timedelta(days=2), "ord": 1000}]
    files, folder = [log[:60], log[60:120], log[120:]], tmp_path / "in"
    folder.mkdir()
    shuffled = [rng.sample(f, len(f)) for f in files]
    # late by up to 50 minutes, and repeated
    shuffled[1] += [shuffled[0].pop() for _ in range(5)] + shuffled[0][:7]
    shuffled[2] += shuffled[1][:9]
    late_ok = lambda r, f: True
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        stream = read_files(spark, str(folder), spark.createDataFrame([], SCHEMA).schema)
        changes = follow_assets(stream, ["e", "v"], 2, dt.timedelta(hours=6), "3 hours")
        start_following(changes, out, checkpoint)

    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        for i, rows in enumerate([*shuffled, ends]):  # a new query for each file: a restart between
            text = "\n".join(json.dumps(r | {"at": r["at"].isoformat()}) for r in rows if late_ok(r, i))
            (folder / f"f{i}.json").write_text(text)
            run()
        run()  # nothing new
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    whole = spark.createDataFrame([(r["asset"], r["status"], r["at"], r["ord"]) for r in log + ends], SCHEMA)
    ms = lambda t: F.unix_millis(t)
    want = logs.ledger_latest(whole, "asset", ["at", "ord"]).select("asset", "status", ms("at").alias("at"), "ord")
    got = followed(spark, out, "latest").groupBy("asset").agg(F.max_by(F.struct("status", "to_at", "to_ord"), F.struct("to_at", "to_ord")).alias("x")).select("asset", "x.*")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    runs = logs.error_streaks(whole.fillna("none", ["status"]), "asset", ["at", "ord"], "status", ["e", "v"], 2)
    want = runs.select("asset", "status", "length", ms("from_at").alias("a"), "from_ord", ms("to_at").alias("b"), "to_ord")
    got = followed(spark, out, "run").select("asset", "status", "length", "from_at", "from_ord", "to_at", "to_ord")
    assert want.count() > 10 and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    # all assets but the last were silent for six hours
    assert {r["asset"] for r in followed(spark, out, "idle").collect()} == set(range(8))


def test_state_calls_do_not_grow_with_records():
    """An asset with many records in a batch takes as many calls to the state store as one with few."""
    calls = []

    class Store:
        def __init__(self, kept):
            self.kept = kept

        def get(self):
            calls.append("get")
            return iter(self.kept) if isinstance(self.kept, list) else self.kept

        def update(self, value):
            calls.append("update")
            self.kept = value

        def appendList(self, values):
            calls.append("append")
            self.kept = self.kept + values

        def put(self, values):
            calls.append("put")
            self.kept = values

        def clear(self):
            calls.append("clear")
            self.kept = []

    class Handle:
        timers = []

        def getValueState(self, name, schema):
            return Store(None)

        def getListState(self, name, schema):
            return Store([])

        def registerTimer(self, at):
            calls.append("timer")
            self.timers.append(at)

    class Times:
        def __init__(self, at):
            self.getCurrentWatermarkInMs = self.getExpiryTimeInMs = lambda: at

    for n in (10, 10_000):
        calls.clear()
        handle = Handle()
        handle.timers = []
        follow = state._Follow(["e"], 2, 10**9)
        follow.init(handle)
        rows = [{"_at": i, "ord": i, "status": "ok" if i % 5 == 4 else "e"} for i in range(n)]
        assert [r["what"] for r in follow.handleInputRows((1,), iter(rows[::-1]), None)] == ["latest"]
        due = handle.timers[0]
        assert due == 1 and len(calls) <= 4
        # all but the last two records are behind the watermark
        times = Times(n - 2)
        times.getExpiryTimeInMs = lambda: due
        runs = list(follow.handleExpiredTimer((1,), times, times))
        assert sum(r["length"] for r in runs) == sum(r["status"] == "e" for r in rows[: n - 2]) and len(runs) == n // 5
        assert handle.timers[1:] == [n - 1] and len(calls) <= 9
