"""scorewright: KPI scorecards with benchmark comparisons, built on Spark DataFrames.

Layout:
    sources/    scans, latest-snapshot filters, constant relations, sinks
    functions/  Column-level helpers (formatting, safe division, decimals)
    operators/  reusable relational building blocks (joins, aggregates, windows,
                reshaping, table mutations expressed as DataFrame transforms)
    plans/      the user-level jobs (dimension, facts, wide table, metrics,
                benchmark rollup, scorecard, recommendations, footnotes, tooltips,
                header) and the full report refresh
    streaming/  nothing: the workload is a batch refresh (see its docstring)
"""

__all__ = ["session"]
