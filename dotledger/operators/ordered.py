"""Row numbers, running sums and framed windows over ordered groups of which one may hold a large part of all rows.

A group is cut into buckets by the position of its rows, a value of the row itself, so that every bucket is a task of its own and a repeated
task makes the same buckets. Frames of a few rows see copies of the rows at the buckets' edges; running sums add the sums of the buckets
before, of which a group has few.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Positions in a bucket.
WIDTH = 4096


def bucket_of(position: str | Column, width: int = WIDTH) -> Column:
    """The bucket of a numeric position; rows without one are first."""
    return F.coalesce(F.floor((F.col(position) if isinstance(position, str) else position) / width), F.lit(-(2**40))).cast("bigint")


def join_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """An equi-join by `keys` in which nulls are equal; the right side's keys are dropped."""
    r = right.select(*(F.col(k).alias(f"_r{i}") for i, k in enumerate(keys)), *(c for c in right.columns if c not in keys))
    on = [F.col(k).eqNullSafe(F.col(f"_r{i}")) for i, k in enumerate(keys)]
    return left.join(r, on, how).drop(*(f"_r{i}" for i in range(len(keys))))


def before_buckets(df: DataFrame, keys: list[str], sums: dict[str, Column]) -> DataFrame:
    """Rows (keys, _bk, the names of `sums`): what the buckets before each bucket of a group add up to."""
    w = Window.partitionBy(*keys).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    per = df.groupBy(*keys, "_bk").agg(*(F.sum(x).alias(n) for n, x in sums.items()))
    return per.select(*keys, "_bk", *(F.coalesce(F.sum(n).over(w), F.lit(0)).alias(n) for n in sums))


def running_sum(df: DataFrame, keys: list[str], order: list[str], position: str | Column, steps: dict[str, Column]) -> DataFrame:
    """Adds the running sum of each step, the row included, along `order`; a step of 1 numbers the rows. `position` doesn't fall along `order`."""
    placed = df.withColumn("_bk", bucket_of(position)).withColumns({f"_s_{n}": x for n, x in steps.items()})
    within = Window.partitionBy(*keys, "_bk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumns({f"_w_{n}": F.sum(f"_s_{n}").over(within) for n in steps})
    offsets = before_buckets(placed, keys, {f"_o_{n}": F.col(f"_s_{n}") for n in steps})
    out = join_safe(placed, offsets, [*keys, "_bk"])
    return out.withColumns({n: (F.col(f"_w_{n}") + F.col(f"_o_{n}")).cast("bigint") for n in steps}).select(*df.columns, *steps)


def with_edges(df: DataFrame, keys: list[str], order: list[str], position: str | Column, reach: int) -> DataFrame:
    """Adds _bk and _own: the rows, and copies of those within `reach` rows of each bucket, marked by _own = false.

    A window over (keys, _bk) of at most `reach` rows on each side sees what it would see over the whole group; the copies are then dropped.
    """
    placed = df.withColumn("_bk", bucket_of(position))
    up, down = (Window.partitionBy(*keys, "_bk").orderBy(*(F.asc(o) if a else F.desc(o) for o in order)) for a in (True, False))
    numbered = placed.withColumns({"_up": F.row_number().over(up), "_dn": F.row_number().over(down)})
    parts = [numbered.drop("_up", "_dn").withColumn("_own", F.lit(True))]
    for mine, first in (("_dn", False), ("_up", True)):
        # The last rows of every bucket are numbered along the group: a bucket needs the last `reach` of those before it; likewise the first of those after it.
        edge = numbered.filter(F.col(mine) <= reach)
        count = edge.groupBy(*keys, "_bk").agg(F.count("*").alias("_n"))
        side = Window.partitionBy(*keys).orderBy(F.desc("_bk") if first else F.asc("_bk")).rowsBetween(Window.unboundedPreceding, -1)
        count = count.withColumn("_t", F.coalesce(F.sum("_n").over(side), F.lit(0)))
        tail = F.col("_t") + F.col("_n") - F.col(mine) + 1
        edge = join_safe(edge, count.select(*keys, "_bk", "_t", "_n"), [*keys, "_bk"]).withColumn("_at", F.explode(F.sequence(tail, tail + reach - 1))).drop("_t", "_n", "_bk")
        wanting = count.select(*keys, F.col("_bk"), F.col("_t").alias("_at")).filter("_at > 0")
        copies = join_safe(edge, wanting, [*keys, "_at"]).drop("_at", "_up", "_dn").withColumn("_own", F.lit(False))
        parts.append(copies.select(*parts[0].columns))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def framed(df: DataFrame, keys: list[str], order: list[str], position: str | Column, reach: int, columns) -> DataFrame:
    """`df` with columns over a window that reaches at most `reach` rows to each side; `columns` makes them (a dict) from the window's specification."""
    w = Window.partitionBy(*keys, "_bk").orderBy(*order)
    made = columns(w)
    return with_edges(df, keys, order, position, reach).withColumns(made).filter("_own").select(*df.columns, *made)
