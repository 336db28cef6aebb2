"""Golden rows transcribed from the reference's shipped result files (see
FIXTURES.md): the hourly baseline (whole numbers), the two daily totals and
the cumulative curve of 2012-10-10 (ordinary) and 2012-12-25 (holiday)."""

# hour: (ordinary baseline, holiday baseline, expected diff_percent)
BASELINE = {
    0: (896, 864, -3.57), 1: (577, 570, -1.21), 2: (457, 414, -9.41),
    3: (457, 357, -21.88), 4: (804, 561, -30.22), 5: (2173, 1484, -31.71),
    6: (4111, 2763, -32.79), 7: (4740, 3115, -34.28), 8: (4620, 2905, -37.12),
    9: (4419, 3046, -31.07), 10: (4245, 3190, -24.85), 11: (4506, 3594, -20.24),
    12: (4738, 3847, -18.81), 13: (4763, 3927, -17.55), 14: (4965, 4106, -17.30),
    15: (5274, 4208, -20.21), 16: (5680, 4357, -23.29), 17: (5318, 4092, -23.05),
    18: (4306, 3529, -18.04), 19: (3346, 2942, -12.07), 20: (2895, 2559, -11.61),
    21: (2703, 2248, -16.83), 22: (2240, 1774, -20.80), 23: (1525, 1256, -17.64),
}

TOTALS = {"2012-10-10": (0, 91262), "2012-12-25": (1, 39604)}

# date -> cumulative curve for hours 0..23
CURVE = {
    "2012-10-10": [494, 826, 1087, 1448, 3647, 7684, 13559, 20352, 26635, 32315, 36947,
                   41834, 46864, 51931, 57158, 62768, 69054, 74584, 79359, 82699, 85712,
                   88315, 90225, 91262],
    "2012-12-25": [803, 1378, 1730, 1921, 2046, 2254, 2686, 3164, 3806, 4944, 6731, 9045,
                   11594, 14318, 17057, 19845, 22783, 25717, 28661, 31602, 34397, 36767,
                   38525, 39604],
}

# Derived: class of each hour against the whole-number baseline.
HIGH_HOURS = {"2012-10-10": {4, 5}, "2012-12-25": set()}
LOW_HOURS = {"2012-10-10": set(), "2012-12-25": {4, 5, 6, 7, 8, 9}}

# Derived: running day mean at a few hours (tumbling-day reading).
DAY_MEAN = {("2012-10-10", 0): 494.0, ("2012-10-10", 4): 729.4,
            ("2012-10-10", 23): 3802.583, ("2012-12-25", 3): 480.25,
            ("2012-12-25", 23): 1650.167}


def hourly_traffic():
    """(date, hour, traffic): neighbouring differences of the curve."""
    out = []
    for date, curve in CURVE.items():
        prev = 0
        for hour, cum in enumerate(curve):
            out.append((date, hour, cum - prev))
            prev = cum
    return out
