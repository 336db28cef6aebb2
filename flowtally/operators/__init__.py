from flowtally.operators.aggregates import (count_by, daily_average, daily_total, flag_sum,
                                            hourly_baseline, row_count)
from flowtally.operators.alerts import alerts, join_baseline, unmatched_records
from flowtally.operators.prepare import clean, hourly, records
from flowtally.operators.windows import cumulative_curve, rolling_mean, rolling_records, running_day_mean

__all__ = [
    "count_by", "daily_average", "daily_total", "flag_sum", "hourly_baseline", "row_count",
    "alerts", "join_baseline", "unmatched_records", "clean", "hourly", "records", "cumulative_curve",
    "rolling_mean", "rolling_records", "running_day_mean",
]
