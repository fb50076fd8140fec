from pyspark.sql import functions as F

from dotledger.llm import mixing


def _documents(spark, n=600):
    return spark.range(n).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").otherwise("c").alias("source"), F.expr("repeat('token ', cast(id % 40 + 1 as int))").alias("text"), F.lit(1).alias("copies"), F.lit("x").alias("p")
    )


TARGETS = [("a", 0.6, 1), ("b", 0.3, 2), ("missing", 0.1, 3)]


def test_shares_and_repeats(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 50)  # several blocks and levels
    targets = spark.createDataFrame(TARGETS, "source string, target_share double, max_repeats int")
    mixture, shares = mixing.mix_sources(_documents(spark), targets)
    got = {r["source"]: r for r in shares.collect()}
    assert abs(got["a"]["actual_share"] - 2 / 3) < 0.01 and abs(got["b"]["actual_share"] - 1 / 3) < 0.01 and got["missing"]["mixed_tokens"] == 0
    rows = mixture.collect()
    assert len({r["doc_id"] for r in rows}) == len(rows) and max(r["copies"] for r in rows if r["source"] == "a") == 1 and max(r["copies"] for r in rows) <= 2 and {r["source"] for r in rows} == {"a", "b"}
    again = mixing.mix_sources(_documents(spark).repartition(7), targets)[0].collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_balance_of_the_flight():
    import numpy as np

    rng = np.random.default_rng(1)
    size, p = rng.integers(1, 900, 5000).astype(float), np.full(5000, 0.3)
    q = mixing._flight(p, size, rng, 3)
    assert ((q > 0) & (q < 1)).sum() <= 2 and abs(q.sum() - p.sum()) < 1e-6 and abs((q * size).sum() - (p * size).sum()) < 1e-3


def test_edges(spark):
    targets = spark.createDataFrame(TARGETS, "source string, target_share double, max_repeats int")
    odd = spark.createDataFrame([(1, None, "text"), (2, "a", None), (3, "a", ""), (4, "other", "text")], "doc_id bigint, source string, text string")
    mixture, shares = mixing.mix_sources(odd, targets)
    assert mixture.count() == 0 and {r["actual_share"] for r in shares.collect()} == {0.0}
    mixture, _ = mixing.mix_sources(odd.limit(0), targets)
    assert mixture.count() == 0
