"""Losses over a table of predictions. Each loss is a column of one row's loss; test_loss takes the plain mean over rows."""

from __future__ import annotations

import ast
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DICE_EPSILON = 1e-5


def bce_loss(p: Column, y: Column) -> Column:
    """Binary cross-entropy of probabilities, logarithms not under -100."""
    log = lambda x: F.when(x <= 0, -100.0).otherwise(F.greatest(F.ln(x), F.lit(-100.0)))
    return -(y * log(p) + (1 - y) * log(1 - p))


def bce_logits_loss(x: Column, y: Column) -> Column:
    """Binary cross-entropy of logits, in the form that doesn't overflow."""
    return F.greatest(x, F.lit(0.0)) - x * y + F.log1p(F.exp(-F.abs(x)))


def cross_entropy(scores: Column, label: Column) -> Column:
    """log of the summed exponents less the label's score, shifted by the largest score."""
    top = F.array_max(scores)
    return top + F.ln(F.aggregate(scores, F.lit(0.0), lambda a, x: a + F.exp((x - top).cast("double")))) - F.get(scores, label.cast("int"))


def l1_loss(p: Column, y: Column) -> Column:
    return F.abs(p - y)


def soft_dice_loss(logits: Column, truth: Column, epsilon: float = DICE_EPSILON) -> Column:
    """1 - (2 sum(pt) + e) / (sum(p^2) + sum(t^2) + e) of one image's arrays, p the logistic of the logits."""
    p = F.transform(logits, lambda x: 1 / (1 + F.exp(-x.cast("double"))))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    both = total(F.zip_with(p, truth, lambda a, b: a * b))
    return 1 - (2 * both + epsilon) / (total(F.transform(p, lambda x: x * x)) + total(F.transform(truth, lambda x: x.cast("double") * x)) + epsilon)


def focal_loss(scores: Column, label: Column, alpha: float = 1.0, gamma: float = 2.0) -> Column:
    """alpha (1 - pt)^gamma ce, where pt = exp(-ce)."""
    ce = cross_entropy(scores, label)
    return alpha * F.pow(1 - F.exp(-ce), F.lit(gamma)) * ce


_BINARY = {ast.Add: lambda a, b: a + b, ast.Sub: lambda a, b: a - b, ast.Mult: lambda a, b: a * b, ast.Div: lambda a, b: a / b, ast.Pow: lambda a, b: F.pow(a, b)}


def composed_loss(expression: str, parts: dict[str, Column]) -> Column:
    """A column from an arithmetic expression over named parts and numbers; anything else is refused."""

    def column(node: ast.AST) -> Column:
        if isinstance(node, ast.Expression):
            return column(node.body)
        if isinstance(node, ast.Constant) and isinstance(node.value, (int, float)) and not isinstance(node.value, bool):
            return F.lit(float(node.value))
        if isinstance(node, ast.Name) and node.id in parts:
            return parts[node.id]
        if isinstance(node, ast.BinOp) and type(node.op) in _BINARY:
            return _BINARY[type(node.op)](column(node.left), column(node.right))
        if isinstance(node, ast.UnaryOp) and isinstance(node.op, (ast.USub, ast.UAdd)):
            return -column(node.operand) if isinstance(node.op, ast.USub) else column(node.operand)
        raise ValueError(f"not allowed in a loss: {ast.dump(node)[:80]}")

    return column(ast.parse(expression, mode="eval"))


@dataclass(frozen=True)
class Loss:
    """A loss of each row (level "row"), or of all rows together (level "set": `value` is an aggregate)."""

    value: Column
    level: str = "row"


def soft_dice_of_set(p: Column, y: Column, epsilon: float = DICE_EPSILON) -> Loss:
    """1 - (2 sum(py) + e) / (sum(p^2) + sum(y^2) + e) over all rows."""
    total = lambda x: F.coalesce(F.sum(x.cast("double")), F.lit(0.0))
    return Loss(1 - (2 * total(p * y) + epsilon) / (total(p * p) + total(y * y) + epsilon), "set")


class _Terms:
    """A value of two levels: const + sum of factor * row, const and factors over all rows, each row a column of its own.

    Its mean or sum over the rows is an expression over plain aggregates, so that all of a composed loss is one aggregate.
    """

    def __init__(self, const: Column, rows: list[tuple[Column, Column]]) -> None:
        self.const, self.rows = const, rows

    @property
    def pure(self) -> bool:
        return not self.rows

    def times(self, factor: Column) -> _Terms:
        return _Terms(self.const * factor, [(f * factor, r) for f, r in self.rows])

    def plus(self, other: _Terms) -> _Terms:
        return _Terms(self.const + other.const, self.rows + other.rows)

    def reduced(self, how: str) -> Column:
        rows = (lambda r: F.avg(r)) if how == "mean" else (lambda r: F.sum(r))
        out = self.const if how == "mean" or self.pure else self.const * F.count("*")  # a number joins each row's sum
        for factor, row in self.rows:
            out = out + factor * rows(row)
        return out


def _two_levels(expression: str, parts: dict[str, Loss]) -> _Terms:
    """The expression over losses of either level. Products, quotients and powers of losses of the rows with one another stay within the row; with losses of
    the set they must be linear in the rows' losses."""

    def own(node: ast.AST) -> str | None:
        """row, set or None (numbers only): what a part of the expression is made of; "both" if mixed."""
        levels = {parts[n.id].level for n in ast.walk(node) if isinstance(n, ast.Name) and n.id in parts} - {"number"}
        return None if not levels else levels.pop() if len(levels) == 1 else "both"

    def terms(node: ast.AST) -> _Terms:
        if own(node) in ("row", "set", None):
            column = composed_loss(ast.unparse(node), {k: v.value for k, v in parts.items()})
            return _Terms(F.lit(0.0), [(F.lit(1.0), column)]) if own(node) == "row" else _Terms(column, [])
        if isinstance(node, ast.UnaryOp) and isinstance(node.op, (ast.USub, ast.UAdd)):
            return terms(node.operand).times(F.lit(-1.0 if isinstance(node.op, ast.USub) else 1.0))
        if isinstance(node, ast.BinOp):
            a, b = terms(node.left), terms(node.right)
            if isinstance(node.op, (ast.Add, ast.Sub)):
                return a.plus(b.times(F.lit(1.0 if isinstance(node.op, ast.Add) else -1.0)))
            if isinstance(node.op, ast.Mult) and (a.pure or b.pure):
                return b.times(a.const) if a.pure else a.times(b.const)
            if isinstance(node.op, ast.Div) and b.pure:
                return a.times(1 / b.const)
        raise ValueError(f"not linear in the losses of the rows: {ast.unparse(node)[:80]}")

    return terms(ast.parse(expression, mode="eval").body)


def composed(config: dict, losses: dict[str, Loss]) -> Loss:
    """A loss over all rows from {"expression", "components", "variables", "reduction"}.

    A component is the name of a loss in `losses`, or such a dictionary again, whose result is a loss of the set. variables are numbers. What depends on rows is
    reduced by reduction, `mean` (the default) or `sum`; what doesn't is left as it is. Nothing is computed here: all aggregates of a composed loss,
    nested ones included, are those of one `agg`.
    """
    parts = {name: losses[c] if isinstance(c, str) else composed(c, losses) for name, c in config.get("components", {}).items()}
    parts |= {k: Loss(F.lit(float(v)), "number") for k, v in config.get("variables", {}).items()}
    how = config.get("reduction", "mean")
    if how not in ("mean", "sum"):
        raise ValueError(f"unknown reduction: {how}")
    return Loss(_two_levels(config["expression"], parts).reduced(how), "set")


def test_loss(df: DataFrame, loss: Column | Loss, reduction: str = "mean") -> DataFrame:
    """loss over the rows, `mean` or `sum`: every row weighs the same, whatever batches it was scored in. A loss of the set is taken as it is."""
    if isinstance(loss, Loss) and loss.level == "set":
        return df.agg(loss.value.alias("loss"))
    return df.agg((F.avg if reduction == "mean" else F.sum)(loss.value if isinstance(loss, Loss) else loss).alias("loss"))


test_loss.__test__ = False  # not a test, whatever its name looks like
