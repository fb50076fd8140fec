import random

import pytest
from pyspark.sql import Window, functions as F

from dotledger.operators import ordered as O
from tests.conftest import rows


@pytest.mark.parametrize("reach", [1, 3, 7])
def test_like_plain_windows(spark, monkeypatch, reach):
    """Buckets of five positions, of which some are empty, hold one row or many; one group has half of all rows, one key is null."""
    monkeypatch.setattr(O, "WIDTH", 5)
    monkeypatch.setattr(O.bucket_of, "__defaults__", (5,))
    rng = random.Random(reach)
    data = [(rng.choice(["hot", "hot", "a", None]), rng.choice([rng.randrange(60), rng.randrange(300), None]), k, rng.randrange(9)) for k in range(500)]
    df = spark.createDataFrame(data, "g string, p int, u int, x int").repartition(5)
    plain = Window.partitionBy("g").orderBy("p", "u")
    near = lambda w: {"most": F.max("x").over(w.rowsBetween(-reach, reach)), "sum": F.sum("x").over(w.rowsBetween(-reach, 0)), "lead": F.lead("u", reach).over(w), "lag": F.lag("u", reach).over(w)}
    assert rows(O.framed(df, ["g"], ["p", "u"], "p", reach, near)) == rows(df.withColumns(near(plain)))
    total = df.withColumns({"n": F.row_number().over(plain).cast("bigint"), "s": F.sum("x").over(plain.rowsBetween(Window.unboundedPreceding, 0))})
    assert rows(O.running_sum(df, ["g"], ["p", "u"], "p", {"n": F.lit(1), "s": F.col("x")})) == rows(total)


def test_hot_group_is_cut_into_tasks(spark):
    df = spark.range(50_000).select(F.lit("hot").alias("g"), "id")
    placed = O.with_edges(df, ["g"], ["id"], "id", 2)
    sizes = [r["n"] for r in placed.groupBy("g", "_bk").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 13 and max(sizes) <= O.WIDTH + 4 and sum(sizes) == 50_000 + 12 * 4
    assert O.framed(df.limit(0), ["g"], ["id"], "id", 2, lambda w: {"l": F.lag("id").over(w)}).count() == 0
