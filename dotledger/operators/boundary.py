"""The boundary to external models: requests and responses as tables.

A stage makes a request frame; a client answers it; validation picks the first valid attempt. Identical prompts are asked once. The replay client
joins recorded responses and is the default, so that runs are repeatable and offline.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, Window


def make_requests(df: DataFrame, kind: str, key: list[str], prompt: Column, params: str = "", votes: int = 1) -> DataFrame:
    """Rows (request_id, kind, the key columns, vote_no, prompt, params, prompt_sha); request_id depends on these only."""
    voted = df.withColumn("vote_no", F.explode(F.sequence(F.lit(1), F.lit(votes))))
    sha = F.sha2(F.concat_ws("\u0001", F.lit(kind), F.lit(params), prompt), 256)
    out = voted.select(F.lit(kind).alias("kind"), *key, "vote_no", prompt.alias("prompt"), F.lit(params).alias("params"), sha.alias("prompt_sha"))
    return out.withColumn("request_id", F.sha2(F.concat_ws("\u0001", "prompt_sha", *key, F.col("vote_no").cast("string")), 256))


def replay(requests: DataFrame, recorded: DataFrame) -> DataFrame:
    """Responses (request_id, attempt, raw) from a recorded table (prompt_sha, vote_no, attempt, raw)."""
    return requests.select("request_id", "prompt_sha", "vote_no").join(recorded, ["prompt_sha", "vote_no"]).select("request_id", "attempt", "raw")


def ask(requests: DataFrame, client: Callable[[list[str]], list[str]], attempt: int = 1) -> DataFrame:
    """Responses of a Python client, which gets and gives lists of texts; every distinct prompt and vote is asked once."""
    distinct = requests.select("prompt_sha", "vote_no", "prompt").dropDuplicates(["prompt_sha", "vote_no"])

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            answers = client(b.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([attempt] * len(answers), pa.int32()), pa.array(answers, pa.string())], ["prompt_sha", "vote_no", "attempt", "raw"])

    return replay(requests, distinct.mapInArrow(call, "prompt_sha string, vote_no int, attempt int, raw string"))


def first_valid(responses: DataFrame, valid: Column, most: int | None = None) -> DataFrame:
    """The first valid attempt of each request; requests without one are missing."""
    tried = responses.filter(F.col("attempt") <= most) if most else responses
    w = Window.partitionBy("request_id").orderBy("attempt")
    return tried.filter(valid).withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def unanswered(requests: DataFrame, answered: DataFrame) -> DataFrame:
    """Requests for the next round."""
    return requests.join(answered.select("request_id").distinct(), "request_id", "left_anti")
