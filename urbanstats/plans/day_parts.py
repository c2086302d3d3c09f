"""Share of incidents per part of day."""

from pyspark.sql import functions as F

from urbanstats.functions.scalars import day_part_of_hhmm
from urbanstats.operators.aggregates import share_of_total, weighted
from urbanstats.schemas import CRIME_TIME


def day_part_counts(
    incidents, time=CRIME_TIME, where=None, rule=day_part_of_hhmm, repeated_texts=False
):
    """Incidents per part of day. ``rule`` turns a HHMM column into a day part.

    With ``repeated_texts`` the rule sees each distinct time once, which matters most
    where it is a Python function. See :func:`weighted`.
    """
    if where is not None:
        incidents = incidents.filter(where)
    times = weighted(incidents, time, repeated_texts)
    parts = times.select(rule(F.col(time)).alias("day_part"), "weight")
    return parts.groupBy("day_part").agg(F.sum("weight").alias("count"))


def day_part_share(
    incidents, time=CRIME_TIME, where=None, rule=day_part_of_hhmm, repeated_texts=False
):
    """Count and percentage per part of day, largest share first.

    The source is read once. The library's own rules give four groups at most; of
    another rule's groups no number is assumed.
    """
    counts = day_part_counts(incidents, time, where, rule, repeated_texts)
    own = rule is day_part_of_hhmm or getattr(rule, "few_groups", False)
    return share_of_total(counts, few_groups=own).orderBy(
        F.desc("percentage"), F.asc("day_part")
    )
