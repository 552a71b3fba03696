import pytest
from pyspark.sql import functions as F

from wattline.functions.expressions import step_compiler
from wattline.operators import calibration as C
from wattline.sources.messages import decode_formulas


def calibrated(spark, value, steps, operands=None):
    """VAL value of one reading under one formula."""
    formulas = spark.createDataFrame(
        [("i", "vf", steps, operands or {}, 1)],
        "input_id string, feed_id string, steps string, operands map<string,double>, version bigint",
    )
    rows = spark.createDataFrame([("m", "B2", float(value))], "meter_key string, code string, value double")
    registry = spark.createDataFrame([("m", "i", "f")], "meter_key string, input_id string, feed_id string")
    got = {r["kind"]: r for r in C.calibrate(rows, registry, formulas).collect()}
    assert got["ORI"]["value"] == value and got["ORI"]["feed_id"] == "f"
    assert got["VAL"]["feed_id"] == "vf"
    return got["VAL"]["value"]


@pytest.mark.parametrize(
    "value,steps,operands,want",
    [
        (0.1, "+0.2,*3", None, 0.9),
        (100.0, "*1.5,+inputx1,/4", {"x1": 7.25}, 39.3125),
        (8.0, "/0", None, 8.0),
        (8.0, "*2,/0,+1", None, 8.0),
        (8.0, "+inputx2", {"x1": 7.25}, 8.0),
        (8.0, "", None, 8.0),
        (8.0, None, None, 8.0),
        (8.0, "null", None, 8.0),
        (8.0, "2", None, 8.0),
        (8.0, "*2,,+1", None, 17.0),
        (3.0, "--2", None, 5.0),
        (3.0, "-inputx1", {"x1": -2.0}, 5.0),
        (3.0, "*1e2", None, 300.0),
        (-5.0, "*2", None, -10.0),
        # Whole expressions.
        (5.0, "+12*(3+5)/7", None, 18.714285714),
        (5.0, "*(3+5)/7", None, 5.714285714),
        (0.0, "-2+-1*(-3E-2)-(-1)", None, -0.97),
        (5.0, "/(2-2)", None, 5.0),
        (5.0, "*2+inputx1", {"x1": -4.0}, 6.0),
        (5.0, "+007", None, 12.0),
        (5.0, "**2", None, 5.0),
        (5.0, "//2", None, 5.0),
        (5.0, "*x", None, 5.0),
        (5.0, "*(2", None, 5.0),
        (5.0, "*2,*(1+1)", None, 20.0),
        (5.0, "*2,*(1+", None, 5.0),
    ],
)
def test_calibrated_value(spark, value, steps, operands, want):
    assert calibrated(spark, value, steps, operands) == pytest.approx(want, abs=1e-9)


def test_step_becomes_operator_and_constant():
    compile_step = step_compiler()
    assert compile_step("*(3+5)/7") == [{"op": "*", "x": 8.0}, {"op": "/", "x": 7.0}]
    assert compile_step("+2*3") == [{"op": "+", "x": 6.0}]
    assert compile_step("+0.1+0.2") == [{"op": "+", "x": 0.1}, {"op": "+", "x": 0.2}]
    assert compile_step("+(0.1+0.2)") == [{"op": "+", "x": 0.3}]


def registered(spark):
    rows = [(f"m{i % 3}", "B2", float(i), i) for i in range(300)]
    df = spark.createDataFrame(rows, "meter_key string, code string, value double, arrival bigint")
    registry = spark.createDataFrame(
        [("m0", "i0", "f0"), ("m1", "i1", "f1")], "meter_key string, input_id string, feed_id string"
    )
    return df, registry


SCHEMA = "input_id string, feed_id string, steps string, operands map<string,double>, version bigint"


def test_unknown_meters_and_empty_codes_are_dropped(spark):
    df, registry = registered(spark)
    assert {r["input_id"] for r in C.registry_lookup(df, registry).collect()} == {"i0", "i1"}
    assert C.registry_lookup(df.withColumn("code", F.lit("")), registry).count() == 0


def test_inputs_without_formula_give_only_ori(spark):
    df, registry = registered(spark)
    formulas = spark.createDataFrame([("i1", "v1", "*2", {}, 1)], SCHEMA)
    rows = C.calibrate(df, registry, formulas)
    got = {(r["input_id"], r["kind"]): r["count"] for r in rows.groupBy("input_id", "kind").count().collect()}
    assert got == {("i0", "ORI"): 100, ("i1", "ORI"): 100, ("i1", "VAL"): 100}


def test_no_formulas_at_all(spark):
    df, registry = registered(spark)
    empty = spark.createDataFrame([], SCHEMA)
    assert {r["kind"] for r in C.calibrate(df, registry, empty).collect()} == {"ORI"}
    assert {r["kind"] for r in C.calibrate_as_of(df, registry, empty).collect()} == {"ORI"}


def test_newest_version_wins(spark):
    formulas = spark.createDataFrame([("i", "a", "*1", {}, 5), ("i", "b", "*2", {}, 9), ("j", "c", "", {}, 1)], SCHEMA)
    got = {r["input_id"]: r["feed_id"] for r in C.latest_formulas(formulas).collect()}
    assert got == {"i": "b", "j": "c"}


VERSIONS = [("i0", "v", "*2", {}, 0), ("i0", "v", "*3", {}, 60), ("i0", "v", "*4", {}, 61), ("i1", "v", "*5", {}, 250)]


def _as_of(arrival, input_id):
    current = [f for f in VERSIONS if f[0] == input_id and f[4] <= arrival]
    return int(max(current, key=lambda f: f[4])[2][1:]) if current else None


@pytest.mark.parametrize("small", [True, False])
def test_each_reading_sees_the_formula_current_on_arrival(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(C, "MAX_BROADCAST_BYTES", 0)
    df, registry = registered(spark)
    rows = C.calibrate_as_of(df, registry, spark.createDataFrame(VERSIONS, SCHEMA), ranges=15)
    broadcasts = "BroadcastHashJoin [input_id" in rows._jdf.queryExecution().toString()
    assert broadcasts or not small
    got = {(r["arrival"], r["kind"]): r["value"] for r in rows.collect()}
    for i in range(300):
        if i % 3 == 2:
            continue
        factor = _as_of(i, f"i{i % 3}")
        assert got.pop((i, "ORI")) == i
        assert got.pop((i, "VAL"), None) == (None if factor is None else i * factor)
    assert not got


def test_many_versions_of_one_input(spark):
    formulas = spark.createDataFrame([("i0", "v", f"*{k + 1}", {}, 3 * k) for k in range(80)], SCHEMA)
    df, registry = registered(spark)
    rows = C.calibrate_as_of(df, registry, formulas, ranges=10).where("kind = 'VAL'").collect()
    assert {(r["arrival"], r["value"]) for r in rows} == {(3 * k, 3.0 * k * (min(k, 79) + 1)) for k in range(100)}


def test_formula_feed(spark):
    texts = [
        '{"inputId":"i","feedId":"f","steps":"*2","computeInputList":[{"inputId":"a","value":"1.5"},{"inputId":"a","value":"2.5"}]}',
        '{"inputId":"j","feedId":"g","steps":null,"computeInputList":null}',
        "broken",
        "",
    ]
    df = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "value string, arrival bigint")
    got = {r["input_id"]: (r["steps"], r["operands"], r["version"]) for r in decode_formulas(df).collect()}
    assert got == {"i": ("*2", {"a": 2.5}, 0), "j": (None, {}, 1)}


def test_python_sees_formulas_and_no_readings(spark):
    df, registry = registered(spark)
    for steps in ("*2,-1", "*2-1"):
        formulas = spark.createDataFrame([("i0", "v", steps, {}, 1)], SCHEMA)
        rows = C.calibrate(df, registry, formulas)
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        above, below = plan.split("ArrowEvalPython")
        assert "meter_key" in above and "meter_key" not in below
        got = {r["arrival"]: r["value"] for r in rows.where("kind = 'VAL'").collect()}
        assert got == {i: 2.0 * i - 1 for i in range(0, 300, 3)}