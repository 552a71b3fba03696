"""Decimal-exact arithmetic on doubles.

Readings are decimal texts held as doubles, so a plain ``0.1 + 0.2`` is off in the last
digit.  Here both operands become the decimals that their texts show, the operation is
done on those, and the double nearest to its result comes out.  Most operands fit the
decimal types below.  For the others, however large or small, the digits and the power of
ten are told apart: 18 digits each give products of 36, sums and quotients are carried to
more than 30 digits, and one more digit says whether anything follows.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Places that sums of many values are shown with.
PLACES = 9
# Places of a quotient.
QUOTIENT_PLACES = 16
# Operand types (digits, places) whose sum or difference, product or quotient has 38 digits at most.
_SUMS = [((37, 17), (37, 17))]
_PRODUCTS = [((19, 9), (18, 9)), ((19, 5), (18, 5)), ((24, 6), (13, 12)), ((13, 12), (24, 6)), ((19, 18), (18, 18))]
_QUOTIENTS = [((19, 9), (12, 6)), ((16, 5), (15, 5)), ((16, 4), (16, 4)), ((15, 5), (12, 10)), ((18, 3), (12, 6))]
# Digits that the text of a double shows at most (17 where the Java runtime writes the shortest).
DIGITS = 18


def _let(value: Column, use) -> Column:
    """``use(value)``, with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _parts(x: Column) -> Column:
    """A finite double as struct(m, e): m * 10^e is the decimal that its text shows; m has DIGITS digits, or is 0."""
    digits = lambda t: F.ltrim(F.regexp_replace(F.regexp_replace(t, r"E.*$", ""), r"[-.]", ""), F.lit("0"))
    power = lambda t: F.coalesce(F.regexp_extract(t, r"E(.*)$", 1).try_cast("int"), F.lit(0))
    places = lambda t: F.length(F.regexp_extract(t, r"\.(\d*)", 1))

    def split(t: Column) -> Column:
        m = F.rpad(digits(t), DIGITS, "0").cast("bigint") * F.when(t.startswith("-"), -1).otherwise(1)
        return F.struct(m.alias("m"), (power(t) - places(t) + F.length(digits(t)) - DIGITS).alias("e"))

    return _let(x.cast("string"), split)


def _shifted(m: Column, places: Column) -> Column:
    """The whole number m with so many zeros behind it."""
    return F.concat(m.cast("string"), F.repeat(F.lit("0"), places)).cast("decimal(38,0)")


def _double(digits: Column, power: Column) -> Column:
    """The double nearest to digits * 10^power."""
    return F.concat(digits.cast("string"), F.lit("E"), power.cast("string")).cast("double")


def _wide_sum(p: Column) -> Column:
    """a + b. What of the smaller one lies beyond 36 digits of the larger becomes its last digit."""

    def join(p: Column) -> Column:
        x, y, gap = p["x"], p["y"], p["x"]["e"] - p["y"]["e"]
        near = _double((_shifted(x["m"], F.least(gap, F.lit(19))) + y["m"]).cast("decimal(38,0)"), y["e"])
        # A tail of no more than 17 digits and their successor, in units of the larger one's 19th place.
        unit = F.rpad(F.lit("1"), F.least(gap - 17, F.lit(19)), "0").cast("bigint")
        tail = F.call_function("div", y["m"], unit) * 10 + F.signum(y["m"] % unit).cast("bigint")
        tail = F.when(gap > 36, F.signum(y["m"]).cast("bigint")).otherwise(tail)
        far = _double((_shifted(x["m"], F.lit(19)) + tail.cast("decimal(20,0)")).cast("decimal(38,0)"), x["e"] - 19)
        return F.when(gap <= 19, near).otherwise(far)

    a, b = p["a"], p["b"]
    ordered = F.when(a["e"] >= b["e"], F.struct(a.alias("x"), b.alias("y"))).otherwise(F.struct(b.alias("x"), a.alias("y")))
    zero = F.when(a["m"] == 0, _double(b["m"], b["e"])).when(b["m"] == 0, _double(a["m"], a["e"]))
    return zero.otherwise(_let(ordered, join))


def _wide_product(p: Column) -> Column:
    """a * b."""
    a, b = (p[x]["m"].cast("decimal(18,0)") for x in "ab")
    return _double((a * b).cast("decimal(38,0)"), p["a"]["e"] + p["b"]["e"])


def _wide_quotient(p: Column) -> Column:
    """a / b to QUOTIENT_PLACES places; null when the divisor is zero.

    The whole number sought is m1 / m2 * 10^k. Up to k = 30 it is made digit by digit and rounded half up;
    beyond that, 31 digits stand before the rounded place and one more says whether others follow.
    """
    whole = lambda n, m: ((n - n % m).cast("decimal(38,0)") / m).cast("decimal(38,0)")
    rounded = lambda n, m: whole(2 * n + m, 2 * m)
    m1, m2 = (F.abs(p[x]["m"]).cast("decimal(18,0)") for x in "ab")
    gap = p["a"]["e"] - p["b"]["e"]
    k = gap + QUOTIENT_PLACES
    at = lambda m, places: _shifted(m, F.greatest(F.lit(0), F.least(places, F.lit(15))))

    def join(d: Column) -> Column:
        q0, rest = d["q"], d["r"]
        few = F.when(k == -1, rounded(m1, 10 * m2)).when(k >= 0, rounded(at(m1, k), m2)).otherwise(0)
        some = at(q0, k - 15) + rounded(at(rest, k - 15), m2)
        rest = at(rest, F.lit(15))
        more = (at(q0, F.lit(15)) + whole(rest, m2)).cast("decimal(36,0)") * 10 + F.when(rest % m2 == 0, 0).otherwise(1)
        places = F.lit(-QUOTIENT_PLACES)
        return (
            F.when(k <= 15, _double(few.cast("decimal(38,0)"), places))
            .when(k <= 30, _double(some.cast("decimal(38,0)"), places))
            .otherwise(_double(more.cast("decimal(38,0)"), gap - 31))
        )

    first = at(m1, F.lit(15))
    size = _let(F.struct(whole(first, m2).alias("q"), (first % m2).alias("r")), join)
    signed = F.when((p["a"]["m"] < 0) != (p["b"]["m"] < 0), -size).otherwise(size)
    return F.when(p["b"]["m"] == 0, None).when(p["a"]["m"] == 0, 0.0).otherwise(signed)


def _narrow(operate, a: Column, b: Column, types: list) -> Column:
    """``operate`` on decimals of the first types that hold both operands whole; null when none does."""

    def step(pair) -> Column:
        x, y = (v.try_cast(f"decimal({p},{s})") for v, (p, s) in zip((a, b), pair, strict=True))
        whole = (x.cast("double") == a) & (y.cast("double") == b)
        return F.when(whole, operate(x, y).cast("double"))

    return F.coalesce(*map(step, types))


# What an operator does with decimals, with the types it does it in, and with operands told apart.
_OPERATORS = {
    "+": (lambda x, y: x + y, _SUMS, _wide_sum),
    "-": (lambda x, y: x - y, _SUMS, _wide_sum),
    "*": (lambda x, y: x * y, _PRODUCTS, _wide_product),
    "/": (lambda x, y: F.round(F.try_divide(x, y), QUOTIENT_PLACES), _QUOTIENTS, _wide_quotient),
}


def operated(op: Column, a: Column, b: Column, operators: str = "+-*/") -> Column:
    """a op b; null for another operator. Operands that are not finite are computed as doubles."""
    cases = [(op == o, *_OPERATORS[o]) for o in operators]

    def choose(of) -> Column:
        column = F
        for case in cases:
            column = column.when(case[0], of(*case[1:]))
        return column

    narrow = choose(lambda operate, types, _: _narrow(operate, a, b, types))
    plain = choose(lambda operate, *_: operate(a, b))
    second = F.when(op == "-", -b).otherwise(b) if "-" in operators else b
    parts = F.struct(_parts(a).alias("a"), _parts(second).alias("b"))
    wide = _let(parts, lambda p: choose(lambda *own: own[-1](p)))
    finite = (F.abs(a) < float("inf")) & (F.abs(b) < float("inf"))
    return F.coalesce(narrow, F.when(finite, wide).otherwise(plain))


def add(a: Column, b: Column) -> Column:
    return operated(F.lit("+"), a, b, "+")


def subtract(a: Column, b: Column) -> Column:
    return operated(F.lit("-"), a, b, "-")


def multiply(a: Column, b: Column) -> Column:
    return operated(F.lit("*"), a, b, "*")


def divide(a: Column, b: Column) -> Column:
    """Null when the divisor is zero."""
    return operated(F.lit("/"), a, b, "/")


def round_half_up(value: Column, scale: int) -> Column:
    if scale < 0:
        raise ValueError("scale must not be negative")
    return F.round(value, scale)
