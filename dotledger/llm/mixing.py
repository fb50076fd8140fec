"""Mixing sources to target weights by balanced sampling (the cube method)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from dotledger.llm.bpe import VOCABULARY, count_tokens
from dotledger.plans.session import cut, ship_package

#: Documents of one block of the flight phase. A source of any size is spread over as many blocks as it needs.
BLOCK = 10_000
#: Targets that are collected to the driver and broadcast at most.
MOST_TARGETS = 10_000
_EDGE = 1e-9


def _flight(p: np.ndarray, size: np.ndarray, rng: np.random.Generator, units: int) -> np.ndarray:
    """Move the probabilities `p` through the null space of the balancing constraints until fewer than `units` are fractional.

    With three units the direction keeps both the count and the size total, with two only the size total.
    """
    p, size = p.tolist(), [float(x) for x in size]
    draws = iter(rng.random(len(p) + 8).tolist())
    active: list[int] = []
    for k in range(len(p)):
        if _EDGE < p[k] < 1 - _EDGE:
            active.append(k)
        while len(active) == units:
            x = [size[j] for j in active]
            if units == 3:
                u = [x[2] - x[1], x[0] - x[2], x[1] - x[0]]  # orthogonal to (1, 1, 1) and to the sizes
                if not any(u):
                    u = [1.0, -1.0, 0.0]
            else:
                u = [x[1], -x[0]] if any(x) else [1.0, -1.0]
            up = min((1 - p[j]) / d if d > 0 else -p[j] / d for j, d in zip(active, u) if d)
            down = min(p[j] / d if d > 0 else (p[j] - 1) / d for j, d in zip(active, u) if d)
            move = up if next(draws, 0.5) < down / (up + down) else -down
            left = []
            for j, d in zip(active, u):
                q = p[j] + move * d
                p[j] = 0.0 if q <= _EDGE else 1.0 if q >= 1 - _EDGE else q
                if 0.0 < p[j] < 1.0:
                    left.append(j)
            active = left
    return np.asarray(p)


def _cube(last: bool, seed: int):
    """The grouped function of one level."""
    return lambda pdf: _block(pdf, last, seed)


def _block(pdf: pd.DataFrame, last: bool, seed: int) -> pd.DataFrame:
    """One block's flight; on the last level also the landing, which drops the count's constraint, then the size's."""
    pdf = pdf.sort_values("doc_id", kind="stable").reset_index(drop=True)
    rng = np.random.default_rng([seed, len(pdf), *(int(x) & 0xFFFFFFFF for x in pdf["doc_id"].head(2))])
    size = pdf["n_tokens"].to_numpy(float)
    p = _flight(pdf["p"].to_numpy(float), size, rng, 3)
    if last:
        p = _flight(p, size, rng, 2)
        open_ = np.flatnonzero((p > 0) & (p < 1))
        p[open_] = rng.random(len(open_)) < p[open_]
    pdf["p"] = p
    return pdf[["doc_id", "source", "n_tokens", "whole", "p"]]


def target_budget(sizes: DataFrame, targets: DataFrame, total: float | None = None) -> list[dict]:
    """For every target its source's documents and tokens and the tokens to take.

    `sizes` has (source, docs, tokens), one row per source. Without `total` the mixture is the largest in which every available source can have its share within its
    repeats. A target without tokens in the corpus can't be met: the others then keep their proportions to each other.
    """
    if targets.limit(MOST_TARGETS + 1).count() > MOST_TARGETS:
        raise ValueError(f"over {MOST_TARGETS} targets")
    wanted = targets.groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats")).filter("source is not null")
    rows = [r.asDict() for r in wanted.join(sizes, "source", "left").orderBy("source").collect()]
    able = [r for r in rows if (r["tokens"] or 0) > 0 and (r["target_share"] or 0) > 0 and (r["max_repeats"] or 0) > 0]
    most = min((r["max_repeats"] * r["tokens"] / r["target_share"] for r in able), default=0.0)
    total = most if total is None else min(total, most)
    for r in rows:
        r["take"] = total * r["target_share"] if r in able else 0.0
    return rows


def mix_sources(df: DataFrame, targets: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", total: float | None = None, seed: int = 0, vocabulary: str = VOCABULARY) -> tuple[DataFrame, DataFrame]:
    """The mixture, rows (doc_id, source, n_tokens, copies), and its shares, one row per target.

    Every document of a source is expected equally often: its copies are the whole part of that expectation, plus one with the
    probability of the rest, drawn by the cube method so that each source's tokens and documents keep their totals. The flight
    phase runs in blocks of at most `BLOCK` documents, then over what the blocks leave fractional (two documents each), until one block
    per source is left, in which the landing ends it: a source's tokens miss their target by less than one document's.

    Documents with a null source, of a source without a target, or without tokens are in no mixture. `targets` has (source,
    target_share, max_repeats); a target that no document can serve has a share of 0. The draw depends on `seed` and the
    documents only, not on partitioning, so a lost executor's work is repeated alike.
    """
    spark = df.sparkSession
    ship_package(spark)
    named = df.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.col(source).alias("source")).filter("source is not null")
    named = named.join(F.broadcast(targets.limit(MOST_TARGETS).select("source").distinct()), "source", "left_semi").select("doc_id", "text", "source")
    sized = cut(count_tokens(named, "doc_id", "text", ["source"], vocabulary).filter("n_tokens > 0"))
    sizes = sized.groupBy("source").agg(F.count("*").alias("docs"), F.sum("n_tokens").alias("tokens"))
    plan = target_budget(sizes, targets, total)
    schema = "source string, target_share double, max_repeats int, docs long, tokens long, take double"
    table = spark.createDataFrame([tuple(r[c] for c in ("source", "target_share", "max_repeats", "docs", "tokens", "take")) for r in plan], schema)
    rate = F.broadcast(table.filter("take > 0").select("source", (F.col("take") / F.col("tokens")).alias("rate")))
    # Times just under a whole number count as whole: at the limit of its repeats, a source is used that often.
    whole = F.floor(F.col("rate") + 1e-12).cast("int")
    current = sized.join(rate, "source").select("doc_id", "source", "n_tokens", whole.alias("whole"), F.greatest(F.lit(0.0), F.col("rate") - whole).alias("p"))
    most = max((r["docs"] for r in plan if r["docs"]), default=0)
    settled = []
    level = 0
    while True:
        last = most <= BLOCK
        blocks = 1 if last else -(-most // BLOCK)
        # Levels differ in their hash, so that what blocks leave is mixed anew.
        block = F.pmod(F.xxhash64("doc_id", F.lit(seed + level)), F.lit(blocks))
        open_ = current.filter(f"p > {_EDGE} and p < 1 - {_EDGE}")
        settled.append(current.filter(f"not (p > {_EDGE} and p < 1 - {_EDGE})"))
        flown = open_.withColumn("b", block).groupBy("source", "b").applyInPandas(_cube(last, seed + level), "doc_id bigint, source string, n_tokens bigint, whole int, p double")
        if last:
            settled.append(flown)
            break
        current = cut(flown)
        most, level = 2 * blocks, level + 1
    drawn = settled[0]
    for part in settled[1:]:
        drawn = drawn.unionByName(part)
    mixture = drawn.select("doc_id", "source", "n_tokens", (F.col("whole") + F.round("p").cast("int")).alias("copies")).filter("copies > 0")
    reached = mixture.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("mixed_tokens"), F.sum("copies").alias("mixed_documents"), F.count("*").alias("used_documents"), F.max("copies").alias("most_copies"))
    every = Window.partitionBy(F.lit(0))  # one row per target, whose number is bounded above
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    shares = F.broadcast(table).join(reached, "source", "left").select(
        "source", "target_share", "max_repeats", zero("docs").alias("documents"), zero("tokens").alias("tokens"), zero("mixed_documents").alias("mixed_documents"),
        zero("used_documents").alias("used_documents"), zero("most_copies").alias("most_copies"), zero("mixed_tokens").alias("mixed_tokens"),
    )
    total_mixed = F.sum("mixed_tokens").over(every)
    return mixture, shares.withColumn("actual_share", F.when(total_mixed > 0, F.col("mixed_tokens") / total_mixed).otherwise(F.lit(0.0)))
