"""Expression texts against the values Python and numpy give, with NULL for what they call missing or infinite."""
import math

import pytest

from panelforge.functions.expressions import ExpressionError, expression, expression_columns
from panelforge.plans.derive import run_derive

ROWS = [(1, 4.0, 0.0, "x", True), (2, None, 2.0, "y", False), (3, -8.0, 3.0, None, True), (4, 2.5, -1.0, "x", None)]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, "id int, a double, `b` double, s string, flag boolean").coalesce(1)


def values(df, text):
    return [r[0] for r in df.select(expression(df, text).alias("v")).collect()]


@pytest.mark.parametrize("text,want", [
    ("a / b", [None, None, -8 / 3, -2.5]),
    ("id / (id - id)", [None] * 4),
    ("a ** 2", [16.0, None, 64.0, 6.25]),
    ("a ** 0.5", [2.0, None, None, math.sqrt(2.5)]),
    ("b ** -1", [None, 0.5, 1 / 3, -1.0]),
    ("10.0 ** (b * 1000)", [1.0, None, None, 0.0]),
    ("max(a, min(b, max(1, id)))", [4.0, 2.0, 3.0, 2.5]),
    ("np.maximum(a, b)", [4.0, None, 3.0, 2.5]),
    ("np.minimum(np.maximum(a, b), 3)", [3.0, None, 3.0, 2.5]),
    ("where(a > 0, 'pos', 'rest')", ["pos", "rest", "rest", "pos"]),
    ("where(a != 4, 1, 0)", [0, 1, 1, 1]),
    ("1 if 0 < a < 4 else 2", [2, 2, 2, 1]),
    ("nullif(id, 2) + 0", [1, None, 3, 4]),
    ("nullif(a, b) - 0", [4.0, None, -8.0, 2.5]),
    ("clip(a, 0, None)", [4.0, None, 0.0, 2.5]),
    ("clip(a, upper=3)", [3.0, None, -8.0, 2.5]),
    ("log(a)", [math.log(4), None, None, math.log(2.5)]),
    ("np.log1p(b)", [0.0, math.log(3), math.log(4), None]),
    ("np.sqrt(np.abs(a))", [2.0, None, math.sqrt(8), math.sqrt(2.5)]),
    ("-id % 3", [2, 1, 0, 2]),
    ("-id // 3", [-1.0, -1.0, -1.0, -2.0]),
    ("s + '_' + s", ["x_x", "y_y", None, "x_x"]),
    ("(s in ['x', 'z']) & ~(id == 1)", [False, False, False, True]),
    ("(s == 'x') | (a < 0)", [True, False, True, True]),
    ("a.fillna(b).between(2, 4)", [True, True, False, True]),
    ("a.isna() or b.notnull()", [True] * 4),
    ("np.round(a / 8 * 2, 0)", [1.0, None, -2.0, 1.0]),
    ("round_trip", None),
    ("np.nan_to_num(a) + np.pi * 0", [4.0, 0.0, -8.0, 2.5]),
])
def test_values(df, text, want):
    if want is None:
        with pytest.raises(ExpressionError, match="unknown name 'round_trip'"):
            expression(df, text)
        return
    got = values(df, text)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g == w or (isinstance(w, float) and g == pytest.approx(w)), (text, got)


@pytest.mark.parametrize("text", ["", "a +", "__import__('os')", "a.__class__", "df.b", "np.load('x')", "[a for a in b]", "lambda: a",
                                  "a[0]", "open('x')", "log(a, b, id)", "a @ b", "a; b", "np.round(a, b)", "s in a", "b'x'"])
def test_everything_else_is_refused(df, text):
    with pytest.raises(ExpressionError):
        expression_columns(df, text)


def test_steps_with_one_and_several_outputs(df):
    out = run_derive(df, [
        {"type": "simple", "method": "expr", "output": ["q", "r"], "config": {"expr": "a / b, max(a, b)"}},
        {"type": "simple", "method": "expr", "output": ["t", "u"], "config": {"expr": ["q * 2", "clip(r, 0, 3)"]}},
        {"type": "simple", "method": "expr", "output": "v", "expr": "where(u >= 3, t, u)"}])
    assert [tuple(r) for r in out.select("r", "u", "v").collect()] == [(4.0, 3.0, None), (2.0, 2.0, 2.0), (3.0, 3.0, pytest.approx(-16 / 3)), (2.5, 2.5, 2.5)]
    with pytest.raises(ExpressionError, match="expected 3 values"):
        run_derive(df, [{"type": "simple", "method": "expr", "output": ["q", "r", "s"], "config": {"expr": "a, b"}}])
