"""Yearly income per head, per area."""

from pyspark.sql import functions as F

from urbanstats import schemas as S
from urbanstats.functions.scalars import key_present, parse_currency, safe_ratio
from urbanstats.operators.aggregates import sum_by_key
from urbanstats.operators.joins import join_with_strategy


def population_by_key(blocks):
    """People and housing units per area, from one row per census block."""
    sums = {S.BLOCK_POPULATION: S.AREA_POPULATION, S.BLOCK_HOUSING: S.AREA_HOUSING}
    return sum_by_key(blocks, S.BLOCK_ZIP, sums).withColumnRenamed(S.BLOCK_ZIP, S.AREA)


def income_table(income):
    """Area and median income as a number, from the published text columns."""
    return income.select(
        F.trim(F.col(S.INCOME_ZIP)).alias(S.AREA),
        parse_currency(F.col(S.INCOME_AMOUNT)).alias(S.AREA_INCOME),
    ).filter(key_present(S.AREA))


def income_per_key(blocks, income, strategy="default", strict=False, split_hot_keys=False):
    """Income per head = median income x housing units / population, by area.

    An area whose income or population is unknown or zero is kept with NULL;
    ``strict`` drops it, before the join. An area with several incomes gives several
    rows. The strategies are those of ``join_with_strategy`` and all give one result.

    The order goes on to the income within an area, so that one area with most of the
    rows is sorted by several tasks, unless its incomes are equal or unknown too.
    """
    population = population_by_key(blocks)
    incomes = income_table(income)
    if strict:
        population = population.filter(F.col(S.AREA_POPULATION) > 0)
        incomes = incomes.filter(F.col(S.AREA_INCOME).isNotNull())
    joined = join_with_strategy(population, incomes, S.AREA, strategy, split_hot_keys)
    paid = F.col(S.AREA_INCOME) * F.col(S.AREA_HOUSING)
    per_head = safe_ratio(paid, F.col(S.AREA_POPULATION))
    return joined.withColumn(S.INCOME_PER_HEAD, per_head).orderBy(S.AREA, S.AREA_INCOME)
