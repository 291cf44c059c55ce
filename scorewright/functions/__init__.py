"""Scalar and aggregate functions.

``functions.sql`` is the one implementation: builders of Spark SQL text, which
plans assemble and hand over in one ``F.expr`` / ``selectExpr`` call.  The
names exported here are the same builders wrapped in ``F.expr``; their
arguments are SQL expressions (a column name is one; ``sql.lit`` makes a
constant).
"""

from functools import wraps

from pyspark.sql import functions as _F

from scorewright.functions import sql as _sql


def _column(build):
    @wraps(build)
    def column(*args, **kwargs):
        return _F.expr(build(*args, **kwargs))
    return column


__all__ = [
    "right", "replace", "if_null", "concat_null", "month_label", "trunc_int", "format_thousands", "format_percent",
    "to_decimal", "round_half_away", "safe_divide", "percent_of", "to_text", "flag_text", "int_div", "add_all",
    "share", "avg_expr", "avg_decimal", "ratio_of_sums", "level_label", "any_nonzero",
]
for _name in __all__:
    globals()[_name] = _column(getattr(_sql, _name))
