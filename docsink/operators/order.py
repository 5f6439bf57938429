"""Order within very large groups: ranks, running sums and running maxima whose groups are no single task.

A group (a log partition, an id) is cut into blocks of its order column, a number such as an offset. Each block is
aggregated, the aggregates are scanned, a row for a block, and rows are scanned within their block. So a task has a block at a time, and
only the blocks' aggregates of a group stand in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Numbers of the order column that are one block; a block has no more rows than that, unless rows share a number.
BLOCK = 1 << 16


def scanned(rows: DataFrame, group: Sequence[str], order: Sequence[str], made: dict[str, tuple], block: int = BLOCK) -> DataFrame:
    """rows with running aggregates of what stands before each row in its group, null for the first.

    order: columns, of which the last is a number and is cut into blocks. made: by new column (aggregate, how two are joined, column):
    F.sum or F.count with a + b, F.max with F.greatest.
    """
    *head, last = order
    cut = [*group, *head, "order_block"]
    rows = rows.withColumn("order_block", F.floor(F.col(last) / block))
    of_block = {f"block_{c}": agg(column) for c, (agg, _, column) in made.items()}
    blocks = rows.groupBy(*cut).agg(*(v.alias(k) for k, v in of_block.items()))
    earlier = W.partitionBy(*group).orderBy(*head, "order_block").rowsBetween(W.unboundedPreceding, -1)
    total = lambda agg: F.sum if agg is F.count else agg
    before = blocks.select(*cut, *(total(agg)(f"block_{c}").over(earlier).alias(f"block_{c}") for c, (agg, _, _) in made.items()))
    within = W.partitionBy(*cut).orderBy(last).rowsBetween(W.unboundedPreceding, -1)
    own = rows.withColumns({f"own_{c}": agg(column).over(within) for c, (agg, _, column) in made.items()})
    joined = own.join(before, cut)
    out = {c: both(F.col(f"block_{c}"), F.col(f"own_{c}")) for c, (_, both, _) in made.items()}
    return joined.withColumns(out).drop("order_block", *of_block, *(f"own_{c}" for c in made))


def added(a: Column, b: Column) -> Column:
    return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))


def placed(rows: DataFrame, group: Sequence[str], order: str, name: str = "place", block: int = BLOCK) -> DataFrame:
    """rows with their place in the group, from 0, by a number that is theirs alone."""
    return scanned(rows, group, [order], {name: (F.count, added, F.lit(1))}, block)
