"""The day-part rule as a vectorised Python UDF, for comparison with the built-in."""

import pyarrow as pa
from pyspark.sql import functions as F

from urbanstats.functions.scalars import DAY_PARTS, OTHER_DAY_PART

# A whole number with the blanks and control bytes around it that Spark's cast strips.
# Negative and longer numbers are not matched: their hour is Night in any case.
WHOLE_NUMBER = r"^[\x00-\x20\x7f]*\+?0*(?P<digits>[0-9]{1,10})[\x00-\x20\x7f]*$"


def day_part_udf():
    """Build the UDF: Arrow arrays in, one day part per HHMM text out.

    The batches stay in Arrow from end to end; no Python object is made per row. The
    rule is nested so that it ships to the workers by value; they need no copy of this
    package.
    """
    parts, other, pattern = DAY_PARTS, OTHER_DAY_PART, WHOLE_NUMBER

    @F.arrow_udf("string")
    def rule(times: pa.Array) -> pa.Array:
        import pyarrow.compute as pc

        digits = pc.struct_field(pc.extract_regex(times, pattern), "digits")
        hours = pc.divide(pc.cast(digits, pa.int64()), 100)
        within = [pc.and_(pc.greater_equal(hours, a), pc.less_equal(hours, z)) for _, a, z in parts]
        chosen = pc.case_when(
            pc.make_struct(*within, field_names=[name for name, _, _ in parts]),
            *[pa.scalar(name) for name, _, _ in parts],
            pa.scalar(other),
        )
        return chosen

    rule.few_groups = True
    return rule
