from urbanstats.plans.day_parts import day_part_counts, day_part_share
from urbanstats.plans.income import income_per_key, income_table, population_by_key
from urbanstats.plans.jobs import save_day_part_share, save_income_per_key, save_top_months
from urbanstats.plans.months import top_months, top_months_sql

__all__ = [
    "day_part_counts",
    "day_part_share",
    "income_per_key",
    "income_table",
    "population_by_key",
    "save_day_part_share",
    "save_income_per_key",
    "save_top_months",
    "top_months",
    "top_months_sql",
]
