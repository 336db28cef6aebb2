"""Physical-plan inspection used by tests and by ``bench.py``.

These read the text of ``explain`` (formatted) to assert the properties the
operators are designed for: filters pushed into the scan, only the needed
columns read, the tiny baseline side broadcast, no window over a whole series.
"""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def executed_plan_text(df: DataFrame) -> str:
    """Final (AQE) plan after running the query once (collects the result, so
    only for result-sized frames in tests)."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def scan_columns(df: DataFrame) -> list[str]:
    """ReadSchema field names of every parquet scan in the plan."""
    out = []
    for line in plan_text(df).splitlines():
        line = line.strip()
        if line.startswith("ReadSchema:"):
            out.append(line.split(":", 1)[1].strip())
    return out
