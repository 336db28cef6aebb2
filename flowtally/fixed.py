"""Fixed values that results must equal.

These are stated plainly and together on purpose: alert labels, ratio
thresholds, the labels of the endpoint check, result formats and the
holiday calendar rules.  Everything else in the package is parameterised.
"""

# --- fixed values: alert classes and their ratio thresholds -------------------
HIGH_ALERT = "HIGH_ALERT"
LOW_ALERT = "LOW_ALERT"
NORMAL = "NORMAL"
HIGH_RATIO = 1.5  # traffic / baseline >= 1.5  -> HIGH_ALERT
LOW_RATIO = 0.5   # traffic / baseline <= 0.5  -> LOW_ALERT

# --- fixed values: day-type labels of the curve-endpoint check ----------------
DAY_TYPE_ORDINARY = "非节假日"
DAY_TYPE_HOLIDAY = "节假日"

# --- fixed values: result formats and window sizes ----------------------------
DATE_FORMAT = "yyyy-MM-dd"
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
ENDPOINT_HOUR = 23
ROLLING_HOURS = 24
HOURS_PER_DAY = 24

# --- fixed values: US federal holiday calendar --------------------------------
# Fixed-date holidays as (month, day).
FIXED_DATE_HOLIDAYS = [
    (1, 1),    # New Years Day
    (7, 4),    # Independence Day
    (11, 11),  # Veterans Day
    (12, 25),  # Christmas Day
]
# Weekday-rule holidays as (month, weekday, nth); weekday 0 = Monday,
# nth counts from 1, and -1 means the last such weekday of the month.
WEEKDAY_RULE_HOLIDAYS = [
    (1, 0, 3),    # Martin Luther King Jr Day: third Monday of January
    (2, 0, 3),    # Washingtons Birthday: third Monday of February
    (5, 0, -1),   # Memorial Day: last Monday of May
    (9, 0, 1),    # Labor Day: first Monday of September
    (10, 0, 2),   # Columbus Day: second Monday of October
    (11, 3, 4),   # Thanksgiving Day: fourth Thursday of November
]
