"""EXP-01..08: expression texts of derive specs as Columns.

A text is a Python expression over column names. Its syntax tree is walked and every node becomes a Column; only the
operators and functions listed here exist, nothing is evaluated and no text is pasted into SQL. Everything stays
inside Catalyst, so an expression is pushed down and compiled like any other.

Missing values are NULL: a zero divisor, the logarithm of zero or less, the root of a negative number, a power or
exponential that overflows give NULL. Comparisons with NULL are false (``!=`` true). Row-wise ``max``, ``min``,
``maximum`` and ``minimum`` skip NULLs; ``np.maximum`` and ``np.minimum`` keep them.
"""
from __future__ import annotations

import ast
import math
from functools import reduce
from operator import and_, or_
from typing import Any, Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ExpressionError(ValueError):
    """A text that is no expression of the supported kind, or names something unknown."""


def _real(x: Column) -> Column:
    """x as double; NaN and infinities become NULL."""
    x = x.cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < F.lit(math.inf)), x)


def _log(fn: Callable[[Column], Column], above: float = 0.0) -> Callable[[Column], Column]:
    return lambda x: F.when(x.cast("double") > above, fn(x.cast("double")))


def divided(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def floor_divided(a: Column, b: Column) -> Column:
    return F.floor(divided(a, b)).cast("double")


def remainder(a: Column, b: Column) -> Column:
    """Python's remainder: it has the divisor's sign."""
    return F.when(b != 0, a - b * F.floor(divided(a, b)))


def power(a: Column, b: Column) -> Column:
    return _real(F.pow(a.cast("double"), b.cast("double")))


def nullif(a: Column, b: Column) -> Column:
    return F.when(~F.coalesce(a == b, F.lit(False)), a)


def where(test: Column, yes: Column, no: Column) -> Column:
    return F.when(test, yes).otherwise(no)


def clip(x: Column, lower: Column | None = None, upper: Column | None = None) -> Column:
    """Bounds of None or NULL leave that side open; NULL stays NULL."""
    out = x
    if lower is not None:
        out = F.when(F.coalesce(x < lower, F.lit(False)), lower).otherwise(out)
    if upper is not None:
        out = F.when(F.coalesce(x > upper, F.lit(False)), upper).otherwise(out)
    return out


def _extreme(fn: Callable[..., Column], keep_null: bool = False) -> Callable[..., Column]:
    def of(*xs: Column) -> Column:
        if not xs:
            raise ExpressionError("needs at least one argument")
        if len(xs) == 1:
            return xs[0]
        found = fn(*xs)
        return F.when(reduce(and_, (x.isNotNull() for x in xs)), found) if keep_null else found
    return of


def _rounded(x: Column, digits: int = 0) -> Column:
    return F.bround(x.cast("double"), int(digits))      # halves to even, as numpy does


def _sign(x: Column) -> Column:
    return F.signum(x.cast("double"))


#: Functions by their plain names.
FUNCTIONS: dict[str, Callable[..., Column]] = {
    "nullif": nullif, "clip": clip, "where": where, "abs": F.abs, "exp": lambda x: _real(F.exp(x.cast("double"))),
    "log": _log(F.ln), "log1p": _log(F.log1p, -1.0), "sqrt": lambda x: F.when(x >= 0, F.sqrt(x.cast("double"))),
    "max": _extreme(F.greatest), "maximum": _extreme(F.greatest), "min": _extreme(F.least), "minimum": _extreme(F.least),
}

#: Functions of ``np.``.
NUMPY: dict[str, Callable[..., Column]] = {
    **{k: FUNCTIONS[k] for k in ("abs", "exp", "log", "log1p", "sqrt", "where", "clip")},
    "absolute": F.abs, "fabs": F.abs, "fmax": _extreme(F.greatest), "fmin": _extreme(F.least),
    "maximum": _extreme(F.greatest, True), "minimum": _extreme(F.least, True), "expm1": lambda x: _real(F.expm1(x.cast("double"))),
    "exp2": lambda x: power(F.lit(2.0), x), "log2": _log(F.log2), "log10": _log(F.log10), "power": power,
    "square": lambda x: x * x, "cbrt": lambda x: F.cbrt(x.cast("double")), "sign": _sign, "negative": lambda x: -x,
    "add": lambda a, b: a + b, "subtract": lambda a, b: a - b, "multiply": lambda a, b: a * b, "divide": divided,
    "true_divide": divided, "floor_divide": floor_divided, "mod": remainder, "remainder": remainder,
    "reciprocal": lambda x: divided(F.lit(1.0), x), "floor": lambda x: F.floor(x).cast("double"),
    "ceil": lambda x: F.ceil(x).cast("double"), "trunc": lambda x: _sign(x) * F.floor(F.abs(x)),
    "rint": _rounded, "round": _rounded, "around": _rounded,
    "sin": F.sin, "cos": F.cos, "tan": F.tan, "sinh": F.sinh, "cosh": lambda x: _real(F.cosh(x)), "tanh": F.tanh,
    "arcsin": lambda x: _real(F.asin(x)), "arccos": lambda x: _real(F.acos(x)), "arctan": F.atan, "arctan2": F.atan2,
    "hypot": F.hypot, "radians": F.radians, "deg2rad": F.radians, "degrees": F.degrees, "rad2deg": F.degrees,
    "isnan": lambda x: x.isNull(), "isfinite": lambda x: x.isNotNull(), "nan_to_num": lambda x: F.coalesce(x, F.lit(0.0)),
    "logical_and": lambda a, b: a & b, "logical_or": lambda a, b: a | b, "logical_not": lambda a: ~a,
    "equal": lambda a, b: F.coalesce(a == b, F.lit(False)), "greater": lambda a, b: F.coalesce(a > b, F.lit(False)),
    "less": lambda a, b: F.coalesce(a < b, F.lit(False)),
}
NUMPY_VALUES = {"pi": math.pi, "e": math.e, "nan": None, "inf": math.inf}

#: Methods of a column.
METHODS: dict[str, Callable[..., Column]] = {
    "fillna": lambda x, v: F.coalesce(x, v), "isna": lambda x: x.isNull(), "isnull": lambda x: x.isNull(),
    "notna": lambda x: x.isNotNull(), "notnull": lambda x: x.isNotNull(), "abs": F.abs, "clip": clip, "round": _rounded,
    "between": lambda x, lo, hi: F.coalesce((x >= lo) & (x <= hi), F.lit(False)),
}

_ARITHMETIC = {ast.Sub: lambda a, b: a - b, ast.Mult: lambda a, b: a * b, ast.Div: divided, ast.FloorDiv: floor_divided,
               ast.Mod: remainder, ast.Pow: power, ast.BitAnd: and_, ast.BitOr: or_}
_COMPARISONS = {ast.Eq: lambda a, b: a == b, ast.Lt: lambda a, b: a < b, ast.LtE: lambda a, b: a <= b,
                ast.Gt: lambda a, b: a > b, ast.GtE: lambda a, b: a >= b}


class _Walker:
    """Turns syntax nodes into Columns over the columns of ``df``."""

    def __init__(self, df: DataFrame, text: str):
        self.df, self.text, self.columns = df, text, set(df.columns)

    def fail(self, what: str) -> ExpressionError:
        return ExpressionError(f"{what} in expression {self.text!r}")

    def is_text(self, *values: Column) -> bool:
        return any(isinstance(f.dataType, T.StringType) for f in self.df.select(*values).schema.fields)

    def __call__(self, node: ast.AST) -> Column:
        visit = getattr(self, "on_" + type(node).__name__.lower(), None)
        if visit is None:
            raise self.fail(f"{type(node).__name__} is not supported")
        return visit(node)

    def on_name(self, node: ast.Name) -> Column:
        if node.id not in self.columns:
            raise self.fail(f"unknown name {node.id!r}")
        return F.col(f"`{node.id}`")

    def on_constant(self, node: ast.Constant) -> Column:
        if not (node.value is None or isinstance(node.value, (bool, int, float, str))):
            raise self.fail(f"value {node.value!r}")
        return F.lit(node.value)

    def on_attribute(self, node: ast.Attribute) -> Column:
        if isinstance(node.value, ast.Name) and node.value.id == "np" and node.attr in NUMPY_VALUES:
            value = NUMPY_VALUES[node.attr]
            return F.lit(value).cast("double")
        raise self.fail(f"unknown attribute {node.attr!r}")

    def on_unaryop(self, node: ast.UnaryOp) -> Column:
        x = self(node.operand)
        if isinstance(node.op, ast.USub):
            return -x
        return x if isinstance(node.op, ast.UAdd) else ~x

    def on_binop(self, node: ast.BinOp) -> Column:
        a, b = self(node.left), self(node.right)
        if isinstance(node.op, ast.Add):
            return F.concat(a.cast("string"), b.cast("string")) if self.is_text(a, b) else a + b
        if type(node.op) not in _ARITHMETIC:
            raise self.fail(f"operator {type(node.op).__name__}")
        return _ARITHMETIC[type(node.op)](a, b)

    def on_boolop(self, node: ast.BoolOp) -> Column:
        return reduce(and_ if isinstance(node.op, ast.And) else or_, map(self, node.values))

    def on_compare(self, node: ast.Compare) -> Column:
        found, left = [], self(node.left)
        for op, right in zip(node.ops, node.comparators):
            if isinstance(op, (ast.In, ast.NotIn)):
                if not isinstance(right, (ast.List, ast.Tuple, ast.Set)):
                    raise self.fail("'in' needs a list")
                member = F.coalesce(left.isin(*map(self, right.elts)), F.lit(False))
                found.append(member if isinstance(op, ast.In) else ~member)
                continue
            other = self(right)
            if isinstance(op, ast.NotEq):
                found.append(~F.coalesce(left == other, F.lit(False)))
            elif type(op) in _COMPARISONS:
                found.append(F.coalesce(_COMPARISONS[type(op)](left, other), F.lit(False)))
            else:
                raise self.fail(f"comparison {type(op).__name__}")
            left = other
        return reduce(and_, found)

    def on_ifexp(self, node: ast.IfExp) -> Column:
        return where(self(node.test), self(node.body), self(node.orelse))

    def argument(self, node: ast.AST) -> Any:
        return None if isinstance(node, ast.Constant) and node.value is None else self(node)

    def on_call(self, node: ast.Call) -> Column:
        fn, own = self.function(node.func)
        args = [*own, *map(self.argument, node.args)]
        options = {k.arg: self.argument(k.value) for k in node.keywords}
        if fn is _rounded and len(args) > 1:
            last = node.args[-1]
            if not (isinstance(last, ast.Constant) and isinstance(last.value, int)):
                raise self.fail("digits must be a whole number")
            args[-1] = last.value
        # None is an open bound or side only where the function says so; elsewhere it is NULL
        if fn is not clip:
            args = [F.lit(None) if a is None else a for a in args]
        try:
            return fn(*args, **options)
        except TypeError as error:
            raise self.fail(f"wrong arguments ({error})") from error

    def function(self, node: ast.AST) -> tuple[Callable[..., Column], Sequence[Column]]:
        if isinstance(node, ast.Name) and node.id in FUNCTIONS:
            return FUNCTIONS[node.id], []
        if isinstance(node, ast.Attribute):
            if isinstance(node.value, ast.Name) and node.value.id == "np":
                if node.attr in NUMPY:
                    return NUMPY[node.attr], []
            elif node.attr in METHODS:
                return METHODS[node.attr], [self(node.value)]
            raise self.fail(f"unknown function {ast.unparse(node)!r}")
        raise self.fail(f"unknown function {ast.unparse(node)!r}")


def expression_columns(df: DataFrame, text: str) -> list[Column]:
    """The Columns of an expression over ``df``: one, or one per element of a tuple or list."""
    if not isinstance(text, str) or not text.strip():
        raise ExpressionError("an expression is missing")
    try:
        tree = ast.parse(text.strip(), mode="eval").body
    except SyntaxError as error:
        raise ExpressionError(f"not an expression: {text!r} ({error.msg})") from error
    walk = _Walker(df, text)
    return [walk(n) for n in tree.elts] if isinstance(tree, (ast.Tuple, ast.List)) else [walk(tree)]


def expression(df: DataFrame, text: str) -> Column:
    found = expression_columns(df, text)
    if len(found) != 1:
        raise ExpressionError(f"expected one value, not {len(found)}, in expression {text!r}")
    return found[0]
