from flowtally.plans.checks import (alert_distribution, check_convergence, check_endpoint,
                                    check_high, check_low, check_normal, holiday_diff,
                                    import_counts, preview)

__all__ = [
    "alert_distribution", "check_convergence", "check_endpoint", "check_high", "check_low",
    "check_normal", "holiday_diff", "import_counts", "preview",
]
