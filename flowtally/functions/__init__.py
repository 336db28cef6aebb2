from flowtally.functions.classify import alert_status
from flowtally.functions.holidays import holiday_flag, listed_holiday, us_federal_holiday
from flowtally.functions.scalar import abs_error, abs_error_pct, mean_of, pct_diff, safe_div
from flowtally.functions.time import (event_time, hour_index, hour_index_to_date,
                                      hour_index_to_hour, hour_index_to_string, to_wall_clock)

__all__ = [
    "alert_status", "holiday_flag", "listed_holiday", "us_federal_holiday", "abs_error",
    "abs_error_pct", "mean_of", "pct_diff", "safe_div", "event_time", "hour_index",
    "hour_index_to_date", "hour_index_to_hour", "hour_index_to_string", "to_wall_clock",
]
