"""Arithmetic on doubles of any size against whole decimals."""

import math
import random
from decimal import ROUND_HALF_UP, Decimal, localcontext

from pyspark.sql import functions as F

from wattline.functions.expressions import step_compiler
from wattline.functions.numbers import add, divide, multiply, subtract


def want(a, b):
    """Sum, difference, product and quotient of the decimals that two texts show, as doubles."""
    with localcontext(prec=1400):
        x, y = Decimal(a), Decimal(b)
        quotient = float((x / y).quantize(Decimal("1e-16"), ROUND_HALF_UP)) if y else None
        return float(x + y), float(x - y), float(x * y), quotient


def pairs():
    rng = random.Random(7)
    edges = [0.0, -0.0, 1.0, -1.0, 0.1, 3.0, 1e15, 9.9e16, 1e22, 2e23, 123456789012345680.0, 1.2345678901234567e18]
    edges += [9007199254740993.0, 5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, 1e-7, 1e-16, 4.9e-17, 5e-17]
    rows = [(a, b) for a in edges for b in edges] + [(-a, b) for a in edges for b in edges]
    for spread in (2, 20, 40, 60, 300):
        for _ in range(600):
            digits = lambda: rng.randrange(1, 10 ** rng.randint(1, 17)) * rng.choice((1, -1))
            power = lambda: rng.randint(-spread, min(spread, 290))
            rows.append((float(f"{digits()}E{power()}"), float(f"{digits()}E{power()}")))
    return rows


def test_any_finite_doubles_equal_whole_decimals(spark):
    rows = pairs()
    df = spark.createDataFrame(rows, "a double, b double").repartition(8)
    a, b = F.col("a"), F.col("b")
    # The texts are Spark's own: those of a Java runtime before 19 are not always the shortest.
    got = df.select(a.cast("string"), b.cast("string"), add(a, b).alias("s"), subtract(a, b).alias("d"), multiply(a, b).alias("p"), divide(a, b).alias("q"))
    wrong = []
    for r in got.collect():
        expected = want(r.a, r.b)
        wrong += [(r.a, r.b, name, x, y) for name, x, y in zip("sdpq", r[2:], expected, strict=True) if x != y]
    assert not wrong, (len(wrong), wrong[:8])


def test_what_is_not_finite_stays_so(spark):
    df = spark.createDataFrame([(math.inf, 1.0), (1.0, -math.inf), (math.nan, 2.0), (None, 1.0)], "a double, b double")
    a, b = F.col("a"), F.col("b")
    got = df.select(add(a, b).alias("s"), multiply(a, b).alias("p")).collect()
    assert got[0].s == math.inf and got[1].p == -math.inf and math.isnan(got[2].s) and got[3].s is None


def test_constants_of_many_digits():
    compile_step = step_compiler()
    (op,) = compile_step("+(123456789012345680*98765432109876540)")
    assert op["x"] == want("123456789012345680", "98765432109876540")[2]
    (op,) = compile_step("+(1e22/3)")
    assert op["x"] == want("1e22", "3")[3]
