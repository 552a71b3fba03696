import json
import random
from decimal import Decimal
from types import SimpleNamespace

import brute
import pyarrow as pa
import pytest
from metering import random_readings, readings, seconds
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, LongType, StringType, StructField, StructType

from wattline.operators import usage as U
from wattline.plans import fixtures as X
from wattline.schemas import USAGE_STEPS
from wattline.sinks import keyed, outputs
from wattline.sinks.workspace import workspace
from wattline.sources.messages import read_message_stream
from wattline.streaming import jobs, packs, state

SF = "/root/testdata/sf0.001"
READING = "feed_id string, t bigint, arrival bigint, value double, code string, meter_key string"


def with_code(df):
    return df.withColumn("code", F.lit("B2")).withColumn("meter_key", F.col("feed_id"))


def run(spark, batches, make, checkpoint, write, mode="append"):
    """Feeds the batches one after the other, each through a restart of the job."""
    source = workspace(spark, "source")
    for batch in batches:
        with_code(batch).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(READING).parquet(source)
        jobs.start(make(stream), write, checkpoint, mode).awaitTermination()


def usage_over(spark, batches, steps, life_ms=state.WINDOW_LIFE_MS):
    out = workspace(spark, "usage")
    run(spark, batches, lambda s: state.usage_stream(s, steps, life_ms), workspace(spark, "cp"), jobs.to_table(out), "update")
    return jobs.read_usage(spark, out)


def values(df):
    return {r["doc_id"]: round(r["data_value"], 6) for r in df.collect()}


def test_stream_over_restarts_equals_batch(spark):
    rows = random_readings(300, seed=4)
    # Batches out of time order: late ones revise earlier windows.
    batches = [readings(spark, rows[100:200]), readings(spark, rows[:100]), readings(spark, rows[200:])]
    assert values(usage_over(spark, batches, USAGE_STEPS)) == values(U.usage(readings(spark, rows)))


def test_other_devices_clocks_drop_nothing(spark):
    def at(feed, time, value, arrival):
        return readings(spark, [(feed, f"{time}:00", arrival, value)])

    batches = [at("f", "2024-01-01 01:10", 1, 1), at("ahead", "2099-01-20 01:10", 5, 2), at("f", "2024-01-01 01:20", 9, 3),
               at("lags", "2023-06-01 01:10", 1, 4), at("lags", "2023-06-01 01:30", 3, 5)]
    got = {r["feed_id"]: r["data_value"] for r in usage_over(spark, batches, ["1h"]).collect()}
    assert got == {"f": 8.0, "ahead": 0.0, "lags": 2.0}


class Clock:
    """Stands for Spark's side of a stateful operator: state that outlives its life, timers, the time of a batch."""

    def __init__(self):
        self.now, self.states, self.timers = 0, {}, []

    def getCurrentProcessingTimeInMs(self):
        return self.now

    def registerTimer(self, at):
        self.timers.append(at)

    def getValueState(self, name, schema, life=None):
        return self.states.setdefault(name, Held(self, life))

    def getMapState(self, name, key, value, life=None):
        return self.states.setdefault(name, Held(self, life))


class Held:
    def __init__(self, clock, life):
        self.clock, self.life, self.values = clock, life, {}

    def getValue(self, key):
        at, value = self.values.get(key, (None, None))
        return value if at is not None and (self.life is None or self.clock.now - at < self.life) else None

    def updateValue(self, key, value):
        self.values[key] = (self.clock.now, value)

    def iterator(self):
        return ((k, self.getValue(k)) for k in list(self.values) if self.getValue(k) is not None)

    get = lambda self: self.getValue(())
    update = lambda self, value: self.updateValue((), value)
    clear = lambda self: self.values.clear()


def driven(processor, steps):
    """What a processor gives for each (time, rows) of one key; due timers fire after the rows."""
    clock = Clock()
    processor.init(clock)
    for now, rows in steps:
        clock.now = now
        yield list(processor.handleInputRows(("k",), iter(rows), clock)) if rows else []
        for at in [t for t in clock.timers if t <= now]:
            clock.timers.remove(at)
            list(processor.handleExpiredTimer(("k",), clock, SimpleNamespace(getExpiryTimeInMs=lambda at=at: at)))


def test_first_seen_lives_three_hours_from_its_creation():
    life, minute = state.FIRST_SEEN_LIFE_MS, 60_000
    assert life == 180 * minute
    times = [0, 60 * minute, life - 1, life, life + 1, 2 * life - 1, 2 * life, 5 * life]
    got = driven(state._FirstSeen(life), [(t, [{"arrival": i + 0.5}, {"arrival": i}]) for i, t in enumerate(times)])
    # Readings in between don't renew it.
    assert [[r["arrival"] for r in rows] for rows in got] == [[0], [], [], [3], [], [], [6], [7]]


def test_first_seen_emits_again_when_its_timer_came_first():
    got = driven(state._FirstSeen(100), [(0, [{"arrival": 1}]), (99, [{"arrival": 2}]), (150, []), (151, [{"arrival": 3}]), (249, [{"arrival": 4}])])
    assert [[r["arrival"] for r in rows] for rows in got] == [[1], [], [], [3], []]


def window(t, arrival, value):
    ends = dict(zip(state._ENDS, (t, arrival, value) * 2, strict=True))
    return {"step": "1h", "ws": 0, "we": 3600, **ends}


def test_windows_live_from_their_last_update():
    life = 35 * 24 * state.HOUR_MS
    assert state.WINDOW_LIFE_MS == life
    steps = [(0, [window(0, 1, 10.0)]), (life - 1, [window(600, 2, 15.0)]), (2 * life - 2, [window(1200, 3, 18.0)]), (3 * life, [window(1800, 4, 30.0)])]
    got = [(r["first_value"], r["last_value"]) for rows in driven(state._WindowEnds(None, life), steps) for r in rows]
    assert got == [(10.0, 10.0), (10.0, 15.0), (10.0, 18.0), (30.0, 30.0)]


class Counted(Clock):
    """Counts the calls that reach the state."""

    def __init__(self):
        super().__init__()
        self.calls = 0

    def getValueState(self, name, schema, life=None):
        held = super().getValueState(name, schema, life)
        return SimpleNamespace(get=lambda: self.count(held.get), update=lambda value: self.count(held.update, value))

    def getMapState(self, name, key, value, life=None):
        held = super().getMapState(name, key, value, life)
        return SimpleNamespace(**{c: lambda *x, c=c: self.count(getattr(held, c), *x) for c in ("getValue", "updateValue", "iterator")})

    def count(self, call, *args):
        self.calls += 1
        return call(*args)


def test_many_windows_are_read_and_written_at_once():
    clock, processor = Counted(), state._WindowEnds(None, 100)
    processor.init(clock)
    for now, value in ((0, 1.0), (50, 3.0)):
        clock.now = now
        rows = [window(i * 3600 + now, now, value) | {"ws": i * 3600, "we": (i + 1) * 3600} for i in range(200)]
        got = {(r["feed_id"], r["ws"], r["first_value"], r["last_value"]) for r in processor.handleInputRows(("k",), iter(rows), clock)}
        assert got == {("k", i * 3600, 1.0, value) for i in range(200)}
    assert clock.calls == 4


def test_windows_in_one_pack_keep_lives_of_their_own():
    at = lambda ws, t, arrival, value: window(t, arrival, value) | {"ws": ws, "we": ws + 3600}
    steps = [(0, [at(0, 0, 1, 1.0), at(3600, 3600, 2, 2.0)]), (60, [at(3600, 3700, 3, 5.0)]), (120, [at(0, 10, 4, 9.0), at(3600, 3800, 5, 6.0)])]
    got = [{(r["ws"], r["first_value"], r["last_value"]) for r in rows} for rows in driven(state._WindowEnds(None, 100), steps)]
    assert got == [{(0, 1.0, 1.0), (3600, 2.0, 2.0)}, {(3600, 2.0, 5.0)}, {(0, 9.0, 9.0), (3600, 2.0, 6.0)}]


def test_packs_of_windows_that_fill_more_than_a_buffer(monkeypatch):
    monkeypatch.setattr(packs, "PACK_BYTES", 1000)
    monkeypatch.setattr(state, "_PACKED_OUT", 7)
    rows = [window(i, i, float(i)) | {"feed_id": f"f{i % 20}"} for i in range(300)]
    packed = [{"windows": packs.pack(pa.Table.from_pylist(rows[i : i + 9]))} for i in range(0, 300, 9)]
    ((*out,),) = driven(state._PackedWindowEnds(None, 100), [(0, packed)])
    got = {(r["feed_id"], r["first_value"], r["last_value"]) for o in out for r in packs.unpack(o["windows"]).to_pylist()}
    assert len(out) > 1 and got == {(f"f{i}", float(i), float(280 + i)) for i in range(20)}


def test_usage_state_is_kept_by_group_and_span(spark):
    """Rows of the state don't grow with feeds; missing feeds and wide arrival orders go through."""
    start = seconds("2024-01-30 22:00:00")
    rows = [(f"f{i}" if i else None, start + k * 600, 10**25 * k + i, float(i + k)) for i in range(150) for k in (0, 2, 3, 7)]
    source, out = workspace(spark, "source"), workspace(spark, "usage")
    schema = "feed_id string, t bigint, arrival decimal(38,0), value double"
    frame = spark.createDataFrame([(f, t, Decimal(a), v) for f, t, a, v in rows], schema)
    frame.repartition(3).write.parquet(source)
    stream = state.usage_stream(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source), USAGE_STEPS)
    job = jobs.start(stream, jobs.to_table(out), workspace(spark, "cp"), "update")
    job.awaitTermination()
    key = lambda r: (r["feed_id"], r["step"], r["start_time"], r["data_value"])
    found = keyed.latest_by_key(keyed.read_batches(spark, out), ["feed_id", "step", "start_time"], "batch")
    want = {key(r) for r in U.usage(frame).collect()}
    assert {key(r) for r in found.collect()} == want and len(want) > 900
    # Two spans of six hours, two days and two months, in each group.
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in job.recentProgress) <= 6 * state.FEED_GROUPS


def test_newest_time_lives_from_the_last_reading():
    life = state.NEWEST_LIFE_MS
    assert life == 36 * state.HOUR_MS
    steps = [(0, [{"arrival": 1, "t": 50}]), (life - 1, [{"arrival": 3, "t": 60}, {"arrival": 2, "t": 40}]), (2 * life - 2, [{"arrival": 4, "t": 59}]),
             (3 * life - 2, [{"arrival": 5, "t": 1}])]
    got = [[r["arrival"] for r in rows] for rows in driven(state._InOrder(life), steps)]
    assert got == [[1], [3], [], [5]]


def test_superseded_formulas_serve_late_readings():
    life = state.SUPERSEDED_LIFE_MS
    change = lambda v: {"version": v, "val_feed_id": f"f{v}", "ops": "[]"}
    reading = lambda a: {"version": None, "arrival": a}
    steps = [(0, [reading(5), change(10), reading(10)]), (10, [change(20), reading(25), reading(19), reading(3)]), (20, [change(15), reading(16)]),
             (10 + life, [reading(12), reading(17), reading(22)]), (30 * life, [reading(99), reading(16)])]
    fields = StructType([StructField("version", LongType()), StructField("val_feed_id", StringType()), StructField("ops", StringType())])
    got = [[(r["arrival"], r["val_feed_id"]) for r in rows] for rows in driven(state._FormulaAsOf(fields, ["arrival"], life), steps)]
    assert got == [[(5, None), (10, "f10")], [(25, "f20"), (19, "f10"), (3, None)], [(16, "f15")],
                   [(12, None), (17, "f15"), (22, "f20")], [(99, "f20"), (16, None)]]


def test_many_versions_are_read_and_written_at_once():
    fields = StructType([StructField("version", LongType()), StructField("val_feed_id", StringType()), StructField("ops", StringType())])
    clock, processor = Counted(), state._FormulaAsOf(fields, ["arrival"], 100)
    processor.init(clock)
    for now in (0, 50):
        clock.now = now
        changes = [{"version": now + v, "val_feed_id": f"f{now + v}", "ops": "[]"} for v in range(50)]
        got = list(processor.handleInputRows(("k",), iter([*changes, *({"version": None, "arrival": a} for a in range(100))]), clock))
        assert [r["val_feed_id"] for r in got] == [f"f{min(a, now + 49)}" for a in range(100)]
    assert clock.calls == 8


def test_packed_formulas_equal_a_search_per_reading():
    rng, life, kind = random.Random(3), 10**9, pa.decimal128(38)
    fields = [("version", DecimalType(38)), ("val_feed_id", StringType()), ("ops", StringType())]
    processor = state._PackedFormulaAsOf(StructType([StructField(*f) for f in fields]), ["input_id", "arrival", "n"], life)
    steps, want, known, n, inputs = [], [], {}, 0, ["a", "b", "c", None]
    for now in range(4):
        packed, expected = [], set()
        # A version is sent again, some come late; the third micro-batch brings readings alone.
        fresh = [] if now == 2 else [(i, 10**30 + rng.randrange(60)) for i in rng.choices(inputs[:3] if now == 0 else inputs, k=12)]
        for i, v in fresh:
            known.setdefault(i, {})[v] = f"{i}{v}"
        for part in (fresh[:5], fresh[5:]):
            rows = {"part": [inputs.index(i) % 2 for i, _ in part], "input_id": [i for i, _ in part], "val_feed_id": [f"{i}{v}" for i, v in part]}
            table = pa.table(rows | {"version": pa.array([Decimal(v) for _, v in part], kind), "ops": ["[]"] * len(part)})
            packed += [{"readings": None, "changes": packs.pack(table)}] if part else []
        for _ in range(3):
            given = [(rng.choice(inputs), 10**30 + rng.randrange(-5, 70), (n := n + 1)) for _ in range(20)]
            rows = {"part": [inputs.index(i) % 2 for i, _, _ in given], "input_id": pa.array([i for i, _, _ in given], pa.string())}
            table = pa.table(rows | {"arrival": pa.array([Decimal(a) for _, a, _ in given], kind), "n": [k for *_, k in given]})
            packed.insert(0, {"readings": packs.pack(table), "changes": None})
            for i, a, k in given:
                older = [v for v in known.get(i, {}) if v <= a]
                expected.add((i, a, k, known[i][max(older)] if older else None, bool(older)))
        steps.append((now, packed))
        want.append(expected)
    got = [{tuple(r[c] for c in ("input_id", "arrival", "n", "val_feed_id", "has_formula")) for o in out for r in packs.unpack(o["readings"]).to_pylist()}
           for out in driven(processor, steps)]
    assert got == want


def test_formula_state_is_kept_by_part(spark):
    """Rows of the state don't grow with inputs, and what is kept serves the next run."""
    schema = "meter_key string, input_id string, feed_id string, arrival decimal(38,0), value double"
    change = "input_id string, feed_id string, steps string, operands map<string,double>, version bigint"
    out, checkpoint, paths, want = workspace(spark, "dated"), workspace(spark, "cp"), [workspace(spark, n) for n in ("rows", "changes")], {}
    for turn in range(2):
        rows = [(f"m{i}", f"i{i}", f"f{i}", Decimal(turn * 100 + a), 1.0) for i in range(400) for a in (10, 20, 30)]
        changes = [(f"i{i}", f"val{i}-{turn}", f"*{turn + 2}", {}, turn * 100 + 20) for i in range(0, 400, 2)]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(paths[0])
        spark.createDataFrame(changes, change).write.mode("append").parquet(paths[1])
        streams = [spark.readStream.schema(s).parquet(p) for s, p in zip((schema, change), paths, strict=True)]
        job = jobs.start(state.formula_as_of_stream(*streams, groups=2, parts=3, salts=2), jobs.to_table(out), checkpoint)
        job.awaitTermination()
        for m, i, _, a, _ in rows:
            number, at = int(i[1:]), int(a) - 100 * turn
            of = None if number % 2 else turn if at >= 20 else turn - 1 if turn else None
            want[m, int(a)] = None if of is None else f"val{number}-{of}"
        # Current ones and, the second time, superseded ones.
        assert job.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] <= 2 * 2 * 3 * 2
    got = keyed.read_batches(spark, out).collect()
    assert len(got) == len(want) == 2400 and {(r["meter_key"], int(r["arrival"])): r["val_feed_id"] for r in got} == want
    assert all(r["has_formula"] == (r["val_feed_id"] is not None) == (r["ops"] is not None) for r in got)


def test_first_seen_over_restarts(spark):
    rows = [[("m", "2024-01-10 00:00:00", 5, 1), ("m", "2024-01-10 00:10:00", 2, 2), ("known", "2024-01-10 00:00:00", 3, 1)],
            [("m", "2024-01-10 00:20:00", 7, 3), ("n", "2024-01-10 00:00:00", 8, 4)]]
    out = workspace(spark, "first")
    registry = spark.createDataFrame([("known",)], "meter_key string")
    batches = [readings(spark, part) for part in rows]
    run(spark, batches, lambda s: state.first_seen_stream(s, registry), workspace(spark, "cp"), jobs.to_table(out))
    assert {(r["meter_key"], r["arrival"], r["value"]) for r in keyed.read_batches(spark, out).collect()} == {("m", 2, 2.0), ("n", 8, 4.0)}
    # The same with a life that is over when the job starts again.
    out = workspace(spark, "first")
    run(spark, batches, lambda s: state.first_seen_stream(s, registry, 1), workspace(spark, "cp"), jobs.to_table(out))
    assert {(r["meter_key"], r["arrival"]) for r in keyed.read_batches(spark, out).collect()} == {("m", 2), ("m", 7), ("n", 8)}


def test_windows_start_anew_after_their_life(spark):
    batches = [readings(spark, [("f", "2024-01-01 01:10:00", 1, 1)]), readings(spark, [("f", "2024-01-01 01:20:00", 2, 9)])]
    assert list(values(usage_over(spark, batches, ["1h"])).values()) == [8.0]
    assert list(values(usage_over(spark, batches, ["1h"], life_ms=1)).values()) == [0.0]


def test_state_is_kept_in_rocksdb(spark):
    source = workspace(spark, "source")
    with_code(readings(spark, random_readings(50))).write.parquet(source)
    stream = state.first_seen_stream(spark.readStream.schema(READING).parquet(source))
    job = jobs.start(stream, jobs.to_table(workspace(spark, "first")), workspace(spark, "cp"))
    job.awaitTermination()
    assert any("rocksdb" in name for p in job.recentProgress for s in p["stateOperators"] for name in s["customMetrics"])


def test_in_order_acceptance_across_batches(spark):
    out = workspace(spark, "accepted")
    rows = random_readings(300, seed=8)
    batches = [readings(spark, rows[i : i + 100]) for i in (0, 100, 200)]
    run(spark, batches, state.drop_out_of_order_stream, workspace(spark, "cp"), jobs.to_table(out))
    got = {r["arrival"] for r in keyed.read_batches(spark, out).collect()}
    assert got == {r[2] for r in brute.in_order(rows)} and len(got) < 300


def test_a_batch_that_dies_after_its_write_is_repeated_without_a_trace(spark):
    """The job is killed between the sink's write and the commit of the batch, then restarted."""
    rows = random_readings(200, seed=6)
    batches = [readings(spark, rows[:100]), readings(spark, rows[100:])]
    undisturbed, out, checkpoint = usage_over(spark, batches, ["1h"]), workspace(spark, "usage"), workspace(spark, "cp")
    died = []

    def dies_once(frame, batch):
        jobs.to_table(out)(frame, batch)
        if batch == 1 and not died:
            died.append(batch)
            raise RuntimeError("killed between write and commit")

    source = workspace(spark, "source")
    for part in batches:
        with_code(part).coalesce(1).write.mode("append").parquet(source)
        for _ in range(2):
            revised = state.usage_stream(spark.readStream.schema(READING).parquet(source), ["1h"])
            job = jobs.start(revised, dies_once, checkpoint, "update")
            try:
                job.awaitTermination()
                break
            except StreamingQueryException:
                assert died == [1] and keyed.read_batches(spark, out).where("batch = 1").count() > 0
    assert died and values(jobs.read_usage(spark, out)) == values(undisturbed) == values(U.usage(readings(spark, rows), ["1h"]))
    assert {r["batch"] for r in keyed.read_batches(spark, out).select("batch").distinct().collect()} == {0, 1}
    assert keyed.read_batches(spark, out).groupBy("batch", "doc_id").count().where("count > 1").count() == 0


def test_a_batch_written_twice_counts_once(spark):
    path = workspace(spark, "keyed")
    rows = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, v double")
    for _ in range(2):
        keyed.write_batch(rows, path, 0)
    keyed.write_batch(spark.createDataFrame([("b", 3.0)], "k string, v double"), path, 1)
    assert keyed.read_batches(spark, path).count() == 3
    got = {r["k"]: r["v"] for r in keyed.read_keyed(spark, path, ["k"]).collect()}
    assert got == {"a": 1.0, "b": 3.0}


def test_formulas_are_cleared_when_a_job_starts(spark):
    out, checkpoint = workspace(spark, "formulas"), workspace(spark, "cp")
    feeds = [X.formula_envelopes(spark, SF).where(F.col("arrival") % 3 == i) for i in range(3)]

    def job(rows, checkpoint):
        source = workspace(spark, "feed")
        rows.coalesce(1).write.parquet(source)
        stream = jobs.formula_stream(read_message_stream(spark, [source]))
        jobs.start(stream, jobs.to_cleared_table(out), checkpoint).awaitTermination()

    def versions():
        return {r["version"] for r in keyed.read_batches(spark, out).collect()}

    job(feeds[0], workspace(spark, "cp"))
    assert versions() == {r["version"] for r in jobs.decode_formulas(feeds[0]).collect()}
    job(feeds[1], checkpoint)  # a new job
    assert versions() == {r["version"] for r in jobs.decode_formulas(feeds[1]).collect()}


def session_with(master, folder):
    conf = SimpleNamespace(get=lambda key, default: folder if key == "spark.checkpoint.dir" and folder else default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_workspace_is_the_folder_the_session_names():
    named = session_with("spark://host", "s3a://shared/cp/")
    first, second = workspace(named, "x"), workspace(named, "x")
    assert first.startswith("s3a://shared/cp/x-") and first != second
    with pytest.raises(ValueError):
        workspace(session_with("spark://host", None), "x")
    assert "wattline-" in workspace(session_with("local[2]", None), "x")


def online(spark, parts, every=50):
    job = jobs.Online(
        lambda: X.dimensions(spark, SF),
        lambda: jobs.decode_formulas(X.formula_envelopes(spark, SF)),
        workspace(spark, "online"),
        every,
    )
    source, checkpoint = workspace(spark, "feed"), workspace(spark, "cp")
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(source)
        job.start(read_message_stream(spark, [source]), checkpoint).awaitTermination()
    return job


def documents(job, spark):
    return sorted(job.documents(spark).collect())


def test_online_in_parts_equals_online_at_once(spark):
    envelopes = X.envelopes(spark, SF)
    # The third part has nothing in it; the fourth is late and revises what the others wrote.
    bounds = [(300, 900), (900, 1500), (0, 0), (0, 300), (1500, 9999)]
    split = online(spark, [envelopes.where(F.col("arrival").between(a, b - 1)) for a, b in bounds], every=2)
    whole = online(spark, [envelopes])
    assert values(split.usage(spark)) == values(whole.usage(spark))
    assert documents(split, spark) == documents(whole, spark)
    assert {r["index"] for r in split.documents(spark).collect()} == {"phase", "30m", "1h", "1d", "1n"}
    read = [{(r["feedid"], r["time"]): r["value"] for r in job.points(spark).collect()} for job in (split, whole)]
    assert read[0] == read[1]
    for table in ("registry", "input", "feed", "instrument", "iot_bsn", "bsn_schema"):
        read = [job.tables[table].rows(spark) for job in (split, whole)]
        key = "meter_key" if table == "registry" else "id"
        ids = [sorted(r[0] for r in t.select(key).collect()) for t in read]
        assert ids[0] == ids[1] and len(set(ids[0])) == len(ids[0])
    numbers = [r["feed_num"] for r in split.tables["feed"].rows(spark).collect()]
    assert len(set(numbers)) == len(numbers)
    assert keyed.read_batches(spark, f"{split.root}/quarantine").count() == keyed.read_batches(spark, f"{whole.root}/quarantine").count()


def test_repeating_an_online_batch_changes_nothing(spark):
    envelopes = X.envelopes(spark, SF)
    job = online(spark, [envelopes.where("arrival < 900"), envelopes.where("arrival >= 900")])
    before, written = values(job.usage(spark)), documents(job, spark)
    job(envelopes.where("arrival >= 900"), 1)
    assert values(job.usage(spark)) == before and documents(job, spark) == written


def test_a_log_reads_one_epoch(spark):
    log = keyed.Log(workspace(spark, "log"), 3, lambda rows: keyed.latest_by_key(rows, ["k"], "batch"))
    want = {}
    for batch in range(8):
        log.begin(spark, batch)
        if batch:
            earlier = log.before(spark, batch)
            assert {r["k"]: r["v"] for r in keyed.latest_by_key(earlier, ["k"], "batch").collect()} == want
            assert earlier.select("batch").distinct().count() <= 3
        log.write(spark.createDataFrame([(batch % 5, batch)], "k int, v int"), batch)
        want[batch % 5] = batch
    assert {r["k"]: r["v"] for r in keyed.latest_by_key(log.rows(spark), ["k"], "batch").collect()} == want


def test_points_and_documents(spark):
    rows = readings(spark, [("f", "2020-05-11 10:10:00", 1, 1), ("f", "2020-05-11 10:10:00", 2, 3)])
    (point,) = outputs.points(rows).collect()
    assert (point["feedid"], point["value"], point["time"]) == ("f", 3.0, 1589163000000)
    (doc, *_) = outputs.documents(U.usage(rows, ["1h"])).collect()
    source = json.loads(doc["source"])
    assert doc["_id"] == f"f{source['start_time']}{source['end_time']}" and source["step"] == "1h"
    (batch,) = outputs.six_second_batches(rows).collect()
    assert (batch["batch_start"], batch["points"]) == (1589163000000, 1)


def test_continuous_trigger_and_recovery_settings(spark):
    assert jobs.POINT_TRIGGER == "6 seconds" and "RocksDB" in jobs.ROCKSDB["spark.sql.streaming.stateStore.providerClass"]
    out = workspace(spark, "points")
    path = workspace(spark, "source")
    with_code(readings(spark, random_readings(50))).write.parquet(path)
    stream = spark.readStream.schema(READING).parquet(path)
    job = jobs.start(
        stream, lambda rows, batch: keyed.write_batch(outputs.points(rows), out, batch), workspace(spark, "cp"), every="1 second"
    )
    job.processAllAvailable()
    job.stop()
    assert keyed.read_batches(spark, out).count() > 0
