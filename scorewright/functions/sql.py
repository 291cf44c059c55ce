"""Functions as Spark SQL text (SURVEY G/H, aggregates of D): built-in expressions only, no Python UDFs.

Plans that build many expressions (the KPI catalogue, the value formatting,
the comparison join conditions) assemble SQL text and hand it to Spark once
(``F.expr`` / ``selectExpr``): one driver round trip per expression instead
of one per operator node.  Arguments are SQL expressions (a column name is
one).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from scorewright.fixed import KPI_DECIMAL, MISSING_TEXT, NO, PERCENT_PLACES, RATIO_PLACES, WIDEN_DECIMAL, YES

__all__ = [
    "lit", "right", "replace", "if_null", "concat_null", "month_label", "trunc_int", "format_thousands",
    "format_percent", "to_decimal", "round_half_away", "safe_divide", "percent_of", "to_text", "flag_text",
    "int_div", "add_all", "share", "avg_expr", "avg_decimal", "ratio_of_sums", "level_label", "any_nonzero", "isin",
    "case",
]


def lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def right(c: str, n: int) -> str:
    return f"right({c}, {int(n)})"


def replace(c: str, old: str, new: str = "") -> str:
    return f"replace({c}, {lit(old)}, {lit(new)})"


def if_null(c: str, default: str) -> str:
    """``default`` is an SQL expression (use ``lit`` for a constant)."""
    return f"coalesce({c}, {default})"


def concat_null(*parts: str) -> str:
    return f"concat({', '.join(parts)})"


def month_label(d: str) -> str:
    return f"date_format({d}, 'MMMM yyyy')"


def trunc_int(c: str) -> str:
    return f"CAST({c} AS INT)"


def format_thousands(c: str, missing: str | None = MISSING_TEXT) -> str:
    text = f"format_number({trunc_int(c)}, 0)"
    return text if missing is None else f"coalesce({text}, {lit(missing)})"


def format_percent(c: str, places: int = PERCENT_PLACES, missing: str | None = MISSING_TEXT) -> str:
    text = f"concat(CAST(CAST({c} AS DECIMAL(10,{int(places)})) AS STRING), '%')"
    return text if missing is None else f"coalesce({text}, {lit(missing)})"


def to_decimal(c: str, precision: int = 20, scale: int = 10) -> str:
    return f"CAST({c} AS DECIMAL({int(precision)},{int(scale)}))"


def round_half_away(c: str, places: int = 0) -> str:
    return f"round({c}, {int(places)})"


def safe_divide(a: str, b: str) -> str:
    """Decimal quotient; NULL when either side is NULL or b is zero.

    The coalesce with a typed NULL lets Spark widen each side on its own:
    integers become decimal(20,0) and decimals keep their scale, so neither
    side is rounded before the division.
    """
    wide = "coalesce({}, CAST(NULL AS DECIMAL(20,0)))".format
    return f"try_divide({wide(a)}, {wide(b)})"


def percent_of(a: str, b: str, places: int = RATIO_PLACES) -> str:
    """round(a / b, places) * 100 in the KPI value shape."""
    return f"CAST({round_half_away(safe_divide(a, b), places)} * 100 AS {KPI_DECIMAL})"


def to_text(c: str) -> str:
    return f"CAST({c} AS STRING)"


def flag_text(c: str, yes: str = YES, no: str = NO, on_value: str = "1") -> str:
    return f"CASE WHEN CAST({c} AS STRING) = {lit(on_value)} THEN {lit(yes)} ELSE {lit(no)} END"


def int_div(a: str, b: str) -> str:
    return f"CASE WHEN {b} <> 0 THEN CAST({a} AS BIGINT) div CAST({b} AS BIGINT) END"


def add_all(cols: Sequence[str]) -> str:
    return "(" + " + ".join(cols) + ")"


class Agg(NamedTuple):
    """An aggregate made from partial states that add up.

    ``states`` are SQL aggregates (counts and sums) whose values over parts of
    a group add up to those of the whole; ``final`` makes the result from the
    SQL text of the states.  ``whole`` is the aggregate in one step, where that
    isn't ``final`` over the states (an average has a type of its own).
    """

    states: tuple[str, ...]
    final: Callable[..., str]
    whole: str | None = None

    def sql(self) -> str:
        """The aggregate in one step."""
        return self.whole or self.final(*self.states)

    def then(self, outer: Callable[[str], str]) -> Agg:
        """The same states with ``outer`` applied to the result."""
        return Agg(self.states, lambda *parts: outer(self.final(*parts)), outer(self.whole) if self.whole else None)


def plain_agg(aggregate: str) -> Agg:
    """A count or a sum, its own state."""
    return Agg((aggregate,), lambda state: state)


def share_agg(flag: str, on_value: str, ids: str) -> Agg:
    hit = f"count(CASE WHEN CAST({flag} AS STRING) = {lit(on_value)} THEN {flag} END)"
    return Agg((hit, f"count({ids})"), percent_of)


def avg_expr_agg(cols: Sequence[str], integer: bool = True) -> Agg:
    """AVG of a sum of columns; a row counts only when every addend is non-NULL.

    The source engine truncates the average of integers (``sum div count``);
    that of others is a plain average.
    """
    total = add_all(cols)
    states = f"sum({total})", f"count({total})"
    return Agg(states, int_div) if integer else Agg(states, mean_of, f"avg({total})")


def mean_of(total: str, n: str) -> str:
    return f"try_divide({total}, {n})"


def avg_decimal_agg(c: str, places: int = 0) -> Agg:
    wide = f"CAST({c} AS {WIDEN_DECIMAL})"
    return Agg((f"sum({wide})", f"count({wide})"), mean_of, f"avg({wide})").then(lambda mean: round_half_away(mean, places))


def ratio_of_sums_agg(num: str, den: str) -> Agg:
    return Agg((f"sum({num})", f"sum({den})"), percent_of)


def share(flag: str, on_value: str, ids: str) -> str:
    return share_agg(flag, on_value, ids).sql()


def avg_expr(cols: Sequence[str], integer: bool = True) -> str:
    return avg_expr_agg(cols, integer).sql()


def avg_decimal(c: str, places: int = 0) -> str:
    return avg_decimal_agg(c, places).sql()


def ratio_of_sums(num: str, den: str) -> str:
    return ratio_of_sums_agg(num, den).sql()


def level_label(levels: Sequence[str], ids: Sequence[str] | None = None) -> str:
    """Level id from which group columns are NULL, read from the values (not grouping_id()).

    For levels (region, zone, district): region NULL -> '1', zone NULL -> '2',
    district NULL -> '3', else '4'.  A real NULL key in the data is therefore
    labelled like a subtotal, as in the source.
    """
    ids = list(ids or [str(i + 1) for i in range(len(levels) + 1)])
    return case([(f"{name} IS NULL", lit(i)) for name, i in zip(levels, ids)], lit(ids[len(levels)]))


def any_nonzero(measures: Sequence[str]) -> str:
    """TRUE when one of the measures is known and not zero."""
    return f"exists(array({', '.join(measures)}), m -> m <> 0)"


def isin(c: str, values: Sequence) -> str:
    if not values:
        return "FALSE"
    return f"{c} IN ({', '.join(lit(v) for v in values)})"


def case(branches: Sequence[tuple[str, str]], otherwise: str | None = None) -> str:
    """CASE WHEN c1 THEN v1 ... [ELSE e] END; conditions and values are SQL text."""
    body = " ".join(f"WHEN {c} THEN {v}" for c, v in branches)
    tail = f" ELSE {otherwise}" if otherwise is not None else ""
    return f"CASE {body}{tail} END"
