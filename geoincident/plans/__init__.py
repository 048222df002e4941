from geoincident.plans.reports import (
    bearing_histogram, descent_income_report, distance_report, extreme_group_counts,
    load_report, nearest_report, part_of_day_counts, top_months, top_months_sql, weapon_filter)

__all__ = ["bearing_histogram", "descent_income_report", "distance_report",
           "extreme_group_counts", "load_report", "nearest_report", "part_of_day_counts",
           "top_months", "top_months_sql", "weapon_filter"]
