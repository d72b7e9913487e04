"""Feature formulas: + - * / over columns and numbers, compiled to column expressions.

Each division accepts denominators above a floor that depends on all denominators of the frame. Floors of all formulas
are taken together, one aggregation for each depth of nested divisions; everything else is plain expressions.
"""

from __future__ import annotations

import ast

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.numeric import denominator_floor, finite, safe_ratio
from cohortloom.operators.quantiles import grouped_quantiles, interpolated

_OPERATORS = {ast.Add: lambda a, b: a + b, ast.Sub: lambda a, b: a - b, ast.Mult: lambda a, b: a * b}


class FormulaError(ValueError):
    """A formula that uses anything else."""


def parse_formula(text: str, known: dict[str, ast.expr] | None = None) -> ast.expr:
    """The checked tree of a formula, with the formulas of ``known`` features in place of their names."""
    try:
        tree = ast.parse(text, mode="eval").body
    except SyntaxError as error:
        raise FormulaError(f"not a formula: {text!r}") from error

    def checked(node: ast.expr) -> ast.expr:
        match node:
            case ast.Name(id=name):
                return (known or {}).get(name.lower(), node)
            case ast.Constant(value=value) if isinstance(value, int | float) and not isinstance(value, bool):
                return node
            case ast.UnaryOp(op=ast.UAdd() | ast.USub() as op, operand=operand):
                return ast.UnaryOp(op, checked(operand))
            case ast.BinOp(left=left, op=ast.Add() | ast.Sub() | ast.Mult() | ast.Div() as op, right=right):
                return ast.BinOp(checked(left), op, checked(right))
        raise FormulaError(f"{type(node).__name__} is not allowed in {text!r}")

    return checked(tree)


def compile_formulas(df: DataFrame, formulas: dict[str, str], on_error: str = "null") -> dict[str, Column]:
    """Column expressions of ``formulas`` over ``df``; later ones may use earlier ones. Unknown columns are NULL.

    A formula that can't be parsed is a NULL column, or raises with ``on_error='raise'``.
    """
    have = {c.lower(): c for c in df.columns}
    trees: dict[str, ast.expr] = {}
    failed: list[str] = []
    for name, text in formulas.items():
        try:
            trees[name.lower()] = parse_formula(text, trees)
        except FormulaError:
            if on_error == "raise":
                raise
            failed.append(name)
    divisions: dict[str, tuple[int, ast.BinOp]] = {}

    def depth(node: ast.expr) -> int:
        match node:
            case ast.UnaryOp(operand=operand):
                return depth(operand)
            case ast.BinOp(left=left, op=op, right=right):
                own = max(depth(left), depth(right)) + isinstance(op, ast.Div)
                if isinstance(op, ast.Div):
                    divisions[ast.dump(node)] = (own, node)
                return own
        return 0

    floors: dict[str, float] = {}

    def built(node: ast.expr) -> Column:
        match node:
            case ast.Name(id=name):
                return finite(F.col(f"`{have[name.lower()]}`")) if name.lower() in have else F.lit(None).cast("double")
            case ast.Constant(value=value):
                return F.lit(float(value))
            case ast.UnaryOp(op=op, operand=operand):
                return -built(operand) if isinstance(op, ast.USub) else built(operand)
            case ast.BinOp(left=left, op=ast.Div(), right=right):
                return safe_ratio(built(left), built(right), floors[ast.dump(node)])
            case ast.BinOp(left=left, op=op, right=right):
                return _OPERATORS[type(op)](built(left), built(right))
        raise FormulaError(type(node).__name__)

    deepest = max(map(depth, trees.values()), default=0)
    for level in range(1, deepest + 1):
        at = [(key, node) for key, (own, node) in divisions.items() if own == level]
        positive = lambda x: F.when(x > 0, x)
        rows = df.select(F.inline(F.array(*(F.struct(F.lit(i).alias("at"), positive(built(node.right)).alias("value")) for i, (_, node) in enumerate(at)))))
        found = grouped_quantiles(rows, ["at"], F.col("value"), {"q": 0.5}).select("at", interpolated(F.col("q")))
        medians = {i: median for i, median in found.collect()}  # a row a division
        floors |= {key: denominator_floor(medians.get(i)) for i, (key, _) in enumerate(at)}
    out = {name: finite(built(tree)) for name, tree in trees.items()}
    return {name: out.get(name.lower(), F.lit(None).cast("double")) for name in [n.lower() for n in formulas]}
