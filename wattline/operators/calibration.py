"""Registry and formula lookups, and the calibrated value."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.functions.expressions import (
    compound_ops,
    fold_ops,
    is_simple,
    simple_ops,
    step_list,
    substitute,
)
from wattline.operators.readings import nonempty_code
from wattline.operators.running import running
from wattline.schemas import ORI, VAL


# A formula table up to this size, as measured, is broadcast.
MAX_BROADCAST_BYTES = 64 << 20


def latest_formulas(formulas: DataFrame) -> DataFrame:
    """One formula per input: the newest version."""
    names = [c for c in formulas.columns if c not in ("input_id", "version")]
    return (
        formulas.groupBy("input_id")
        .agg(F.max("version").alias("version"), F.max_by(F.struct(*names), "version").alias("f"))
        .select("input_id", "version", "f.*")
    )


def is_small(formulas: DataFrame) -> bool:
    """Whether the formulas may be broadcast: measured, one number to the driver."""
    # A compiled operation takes about 32 bytes and stems from at least two characters of text.
    size = F.lit(200) + 16 * F.coalesce(F.length("steps"), F.lit(0))
    return (formulas.agg(F.sum(size)).first()[0] or 0) <= MAX_BROADCAST_BYTES


def compile_formulas(formulas: DataFrame) -> DataFrame:
    """Adds ``ops``, the steps as (operator, constant) pairs.

    One operator and one operand per step is done with built-ins.  Steps that are
    whole expressions go through Python, per formula.
    """
    simple = is_simple(F.col("steps"))
    texts = F.transform(step_list(F.col("steps")), lambda s: substitute(s, F.col("operands")))
    compound = compound_ops(F.when(~simple, texts))
    return formulas.withColumn("ops", F.when(simple, simple_ops(F.col("steps"), F.col("operands"))).otherwise(compound))


def _lookup_side(formulas: DataFrame, *keys: str) -> DataFrame:
    """The columns a reading takes from its formula; broadcast when measured small."""
    compiled = compile_formulas(formulas)
    side = compiled.select(*keys, F.col("feed_id").alias("val_feed_id"), "ops", F.lit(True).alias("has_formula"))
    return F.broadcast(side) if is_small(formulas) else side


def registry_lookup(readings: DataFrame, registry: DataFrame) -> DataFrame:
    """Readings of registered meters with their input and original feed; others are dropped.

    No hint: the registry is broadcast when its size, as known to the planner,
    allows it, and otherwise joined by key with skewed keys split at run time.
    """
    known = registry.select("meter_key", "input_id", F.col("feed_id").alias("feed_id"))
    return nonempty_code(readings.drop("input_id", "feed_id")).join(known, "meter_key")


def formula_lookup(readings: DataFrame, formulas: DataFrame) -> DataFrame:
    """Adds the formula's feed and operations where the input has a formula.

    Formulas too large to broadcast are joined by input, with hot inputs split at run time.
    """
    return readings.join(_lookup_side(formulas, "input_id"), "input_id", "left")


def apply_formula(readings: DataFrame) -> DataFrame:
    """Adds ``result``: the value after all steps, null when it cannot be computed."""
    result = fold_ops(F.col("value"), F.col("ops"))
    return readings.withColumn("result", F.nanvl(result, F.lit(None).cast("double")))


def emit(readings: DataFrame) -> DataFrame:
    """Each reading as ORI, and once more as VAL under the formula's feed where there is a formula.

    A VAL row without a result keeps the raw value.
    """
    original = F.struct(F.lit(ORI).alias("kind"), F.col("feed_id"), F.col("value"))
    calibrated = F.struct(
        F.lit(VAL).alias("kind"), F.col("val_feed_id").alias("feed_id"), F.coalesce("result", "value").alias("value")
    )
    both = F.when(F.col("has_formula"), F.array(original, calibrated)).otherwise(F.array(original))
    work = ("feed_id", "value", "val_feed_id", "ops", "has_formula", "result")
    return readings.select(*[c for c in readings.columns if c not in work], F.inline(both))


def calibrate(readings: DataFrame, registry: DataFrame, formulas: DataFrame) -> DataFrame:
    """ORI and VAL rows of registered readings under the newest formulas."""
    known = registry_lookup(readings, registry)
    return emit(apply_formula(formula_lookup(known, latest_formulas(formulas))))


def formula_as_of(readings: DataFrame, formulas: DataFrame, ranges: int | None = None) -> DataFrame:
    """Adds ``version``: the newest formula version that arrived no later than the reading.

    Formula arrivals are carried along each input's arrival order, range by
    range, so that neither many readings nor many versions of one input meet
    in one task.
    """
    version = formulas.schema["version"].dataType
    changes = formulas.select("input_id", F.col("version").alias("arrival"), "version", F.lit(False).alias("_reading"))
    rows = readings.withColumn("version", F.lit(None).cast(version)).withColumn("_reading", F.lit(True))
    events = rows.unionByName(changes, allowMissingColumns=True)
    # A change and a reading at the same arrival: the change counts first.
    carried = running(
        events, ["input_id"], {"version": F.max("version")}, order=("arrival", "_reading"), ranges=ranges
    )
    return carried.where("_reading").drop("_reading")


def calibrate_as_of(
    readings: DataFrame, registry: DataFrame, formulas: DataFrame, ranges: int | None = None
) -> DataFrame:
    """ORI and VAL rows, each reading under the formula current when it arrived."""
    dated = formula_as_of(registry_lookup(readings, registry), formulas, ranges)
    side = _lookup_side(formulas, "input_id", "version")
    return emit(apply_formula(dated.join(side, ["input_id", "version"], "left").drop("version")))
