"""Alert classification (L2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowtally.fixed import HIGH_ALERT, HIGH_RATIO, LOW_ALERT, LOW_RATIO, NORMAL
from flowtally.functions.scalar import safe_div


def alert_status(traffic: Column, baseline: Column, high: float = HIGH_RATIO,
                 low: float = LOW_RATIO) -> Column:
    """HIGH_ALERT when traffic/baseline >= high, LOW_ALERT when <= low, else NORMAL.

    A NULL ratio (zero or missing baseline) falls to NORMAL, like SQL's ELSE.
    """
    ratio = safe_div(traffic, baseline)
    return (F.when(ratio >= high, HIGH_ALERT)
             .when(ratio <= low, LOW_ALERT)
             .otherwise(NORMAL))
