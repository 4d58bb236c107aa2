"""Joins to a table of unique keys where one key may hold a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: At most so many keys are broadcast, whatever the size of the data.
MOST_HEAVY = 50_000
#: A key of fewer rows is never heavy.
LEAST_ROWS = 10_000


def attach(
    rows: DataFrame,
    table: DataFrame,
    keys: dict[str, str],
    weight: str,
    most_heavy: int = MOST_HEAVY,
    least_rows: int = LEAST_ROWS,
    how: str = "inner",
    hint: str | None = None,
) -> DataFrame:
    """rows joined (inner or left) with table, whose weight column counts the rows of each key.

    keys maps columns of rows to the equal columns of table, where null equals null; names must
    not clash otherwise. A key with more than a most_heavy-th of all rows is heavy: there are fewer
    than most_heavy of those, so they are broadcast; all others are light enough to be shuffled.
    hint names the join of the light keys. Runs jobs on table when called; both frames should be
    written tables, as they are read twice where there are heavy keys.
    """
    total = table.agg(F.sum(weight)).first()[0] or 0
    border = max(least_rows, total // most_heavy)
    heavy, light = table.filter(F.col(weight) > border), table.filter(F.col(weight) <= border)
    equal = reduce(
        lambda a, b: a & b, [F.col(left).eqNullSafe(F.col(right)) for left, right in keys.items()]
    )
    names = [name for name in (*rows.columns, *table.columns) if name != weight]
    if hint:
        light = light.hint(hint)
    if heavy.isEmpty():
        return rows.join(light, equal, how).select(*names)
    few = F.broadcast(heavy)
    of_heavy = rows.join(few, equal).select(*names)
    of_light = rows.join(few, equal, "left_anti").join(light, equal, how).select(*names)
    return of_heavy.unionByName(of_light)
