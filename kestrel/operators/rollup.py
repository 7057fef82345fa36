"""Long-form subgroup counts: one scan, one shuffle for any number of demographic cuts.

``SELECT .., 'race' AS subgroup, race AS demographic, COUNT(*) .. GROUP BY .., race
  UNION ALL SELECT .., 'elastatus' ..`` reads the table once per cut.  Unpivoting first
(``DataFrame.unpivot`` keeps NULL values, which form their own group) and grouping once gives the
same rows with one scan and one aggregation; partial aggregation runs before the shuffle, so
hot groups are pre-combined map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def subgroup_counts(
    df: DataFrame,
    by: Sequence[str],
    subgroups: Sequence[str],
    *,
    subgroup_col: str = "subgroup",
    value_col: str = "demographic",
    count_col: str = "student_count",
) -> DataFrame:
    """Counts per ``by`` + (subgroup name, subgroup value) in long form."""
    narrow = df.select(*by, *[F.col(s).cast("string").alias(s) for s in subgroups])
    long = narrow.unpivot(list(by), list(subgroups), subgroup_col, value_col)
    return long.groupBy(*by, subgroup_col, value_col).agg(F.count(F.lit(1)).alias(count_col))
