"""Formula steps as lists of (operator, constant).

A step is appended to the value so far, so the value stands left of everything
else in it: ``*(3+5)/7`` multiplies by 8, then divides by 7.  Each formula is
turned into such a list once, where formulas are few; readings, which are many,
only fold the list.
"""

import ast
import re
from decimal import ROUND_HALF_UP, Decimal, localcontext

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from wattline.functions.numbers import operated

NUMBER = r"-?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?"
SIMPLE_STEP = rf"^([-+*/])({NUMBER}|input\w+)$"
OPS = "array<struct<op:string,x:double>>"


def substitute(step: Column, operands: Column) -> Column:
    """Step text with its ``input<id>`` replaced by that operand; null when there is no such operand."""
    used = F.regexp_extract(step, r"input(\w+)$", 1)
    value = F.try_element_at(operands, used).cast("string")
    return F.when(F.length(used) > 0, F.concat(F.regexp_replace(step, r"input\w+$", ""), value)).otherwise(step)


def step_list(steps: Column) -> Column:
    """Comma-separated steps as an array; an empty step leaves the value as it is."""
    return F.filter(F.split(F.coalesce(steps, F.lit("")), ","), lambda s: F.length(s) > 0)


def is_simple(steps: Column) -> Column:
    """Whether every step is one operator and one operand."""
    return F.forall(step_list(steps), lambda s: s.rlike(SIMPLE_STEP))


def simple_ops(steps: Column, operands: Column) -> Column:
    """(operator, constant) per simple step; a constant that cannot be had is null."""

    def op(step):
        operand = F.regexp_extract(step, SIMPLE_STEP, 2)
        number = F.when(
            operand.startswith("input"), F.try_element_at(operands, F.substring(operand, F.lit(6), F.length(operand)))
        ).otherwise(operand.try_cast("double"))
        return F.struct(F.substring(step, 1, 1).alias("op"), number.alias("x"))

    return F.transform(step_list(steps), op)


def fold_ops(value: Column, ops: Column) -> Column:
    """The value after all operations in decimal arithmetic; null when one has no result."""
    return F.aggregate(ops, value, lambda acc, o: operated(o["op"], acc, o["x"]))


def step_compiler():
    """A function from one step's text to its (operator, constant) list.

    Built in one piece so that it travels to the workers by value and the
    package need not be installed there.
    """
    symbols = {ast.Add: "+", ast.Sub: "-", ast.Mult: "*", ast.Div: "/"}

    def operate(op, a, b):
        """One exact decimal operation on the decimal texts of two doubles."""
        x, y = Decimal(repr(a)), Decimal(repr(b))
        with localcontext(prec=1400):  # more digits than any two doubles need
            if isinstance(op, ast.Div):
                return float((x / y).quantize(Decimal("1e-16"), ROUND_HALF_UP))
            return float({"+": x + y, "-": x - y, "*": x * y}[symbols[type(op)]])

    def constant(node):
        if isinstance(node, ast.Constant) and type(node.value) in (int, float):
            return float(node.value)
        if isinstance(node, ast.UnaryOp) and isinstance(node.op, ast.USub):
            return -constant(node.operand)
        if isinstance(node, ast.BinOp):
            return operate(node.op, constant(node.left), constant(node.right))
        raise ValueError("not arithmetic")

    def compile_step(step):
        if not re.fullmatch(r"[0-9.eE+\-*/()]*", step):
            raise ValueError("not arithmetic")
        step = re.sub(r"(?<![0-9.eE])0+(?=[0-9])", "", step)
        node = ast.parse("x" + step, mode="eval").body
        ops = []
        while isinstance(node, ast.BinOp):
            ops.append({"op": symbols[type(node.op)], "x": constant(node.right)})
            node = node.left
        if not isinstance(node, ast.Name) or node.id != "x":
            raise ValueError("value is not leftmost")
        return ops[::-1]

    return compile_step


def compound_ops(steps: Column) -> Column:
    """(operator, constant) list of substituted steps (an array), one formula per row; null stays null.

    An unusable step becomes an operation without a constant, so without a result.
    """
    compile_step = step_compiler()

    @F.pandas_udf(OPS)
    def compile_all(batch: pd.Series) -> pd.Series:
        def compiled(formula):
            if formula is None:
                return None
            try:
                return [op for step in formula for op in compile_step(step)]
            except (ValueError, KeyError, SyntaxError, ArithmeticError, TypeError, RecursionError, MemoryError):
                return [{"op": "+", "x": None}]

        return batch.map(compiled)

    return compile_all(steps)
