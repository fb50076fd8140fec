"""The stages that ask a model, over the boundary of request and response tables: attempts, validation, votes, and what becomes of the answers.

A stage is data: how often an item is asked, how often a failed answer is tried again, how an answer is read, and what holds without one. Prompts come
from the caller. With recorded responses a stage runs offline and gives the same rows each time.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from dotledger.functions import payloads as P
from dotledger.functions.answers import id_list, tolerant_json
from dotledger.functions.tables import canonical_names, pipe_table, table_error
from dotledger.operators.boundary import ask, make_requests, replay
from dotledger.operators.consolidation import verdict_majority
from dotledger.plans.session import ship_package

#: What ends an answer.
END = "<END_OF_JSON>"


def _body(raw: str) -> str:
    """An answer after its thoughts and before its end mark, without a code fence."""
    text = (raw or "").rsplit("</think>", 1)[-1].split(END, 1)[0].strip()
    if text.startswith("```"):
        text = text.split("\n", 1)[-1].removesuffix("```").strip()
    return text


def read_yes_no(raw: str, item: dict) -> Any:
    return "YES" if "YES" in raw.upper() else "NO" if "NO" in raw.upper() else None


def read_text(raw: str, item: dict) -> Any:
    return _body(raw) or None


def read_names(raw: str, item: dict) -> Any:
    return canonical_names(_body(raw)) or None


def read_table(raw: str, item: dict) -> Any:
    """The first table of an answer, if it fits the names of the item."""
    rows = pipe_table(_body(raw))
    return rows if rows and table_error(rows, item.get("names") or []) is None else None


def read_choice(raw: str, item: dict) -> Any:
    """A tagged decision SAME, MERGE (with a value) or CONFLICT."""
    from re import IGNORECASE, DOTALL, search

    m = search(r"<decision>\s*(SAME|MERGE|CONFLICT)\s*</decision>", raw, IGNORECASE)
    v = search(r"<value>(.*?)</value>", raw, IGNORECASE | DOTALL)
    return {"decision": m[1].upper(), "value": v[1].strip() if v else ""} if m and (m[1].upper() == "CONFLICT" or v and v[1].strip()) else None


def read_field(raw: str, item: dict) -> Any:
    """The value of the item's field; what the answer says holds, N/A too."""
    found = tolerant_json(_body(raw))
    return str(found[item["field"]]).strip() or "N/A" if isinstance(found, dict) and item.get("field") in found else None


def read_ids(raw: str, item: dict) -> Any:
    """Ids among the allowed ones; an empty list is an answer."""
    found = tolerant_json(_body(raw))
    ids = found.get("ids", found.get("promote_ids")) if isinstance(found, dict) else found
    return [i for i in dict.fromkeys(int(x) for x in ids if P.number(x) is not None) if i in (item.get("allowed") or ids)] if isinstance(ids, list) else None


def read_json_lines(raw: str, item: dict) -> Any:
    return [x for line in _body(raw).splitlines() if (x := tolerant_json(line)) is not None] or None


def read_hits(raw: str, item: dict) -> Any:
    """Properties or names that hold for the window: those of the item's options."""
    found = tolerant_json(_body(raw))
    found = found.get("hits", found.get("tags", found.get("names"))) if isinstance(found, dict) else found
    return [x for x in item["options"] if x in found] if isinstance(found, list) else None


def read_objects(raw: str, item: dict) -> Any:
    """Refined statements of a property with evidence; retried until one is useful."""
    found = tolerant_json(_body(raw))
    found = [found] if isinstance(found, dict) else found
    held = P.refined_objects(found if isinstance(found, list) else None, item["sample"], item["tag"], item["allowed"], {int(k): v for k, v in item["texts"].items()})
    return held or None


def read_gate(raw: str, item: dict) -> Any:
    """Whether a statement passes; an answer that tells neither keeps it."""
    low = _body(raw).lower()
    return not ("false" in low and "true" not in low)


def read_checked(kind: str, raw: str, item: dict) -> Any:
    found = tolerant_json(_body(raw))
    return found if P.payload_error(kind, found) is None else None


def read_bound(raw: str, item: dict) -> Any:
    found = read_checked("bind", raw, item)
    if found is None:
        return None
    scope, names = P.bound_names(found, item["candidates"])
    return {"scope": scope, "samples": names}


def read_rewrite(raw: str, item: dict) -> Any:
    found = read_checked("rewrite", raw, item)
    return None if found is None else P.rewritten(found["sentence"], item["sample"])[0]


def read_structure(raw: str, item: dict) -> Any:
    """A structured value; "none" ends the vote with nothing."""
    text = _body(raw)
    return {"none": True} if text.lower() == "none" else P.structured_value(item["tag"], tolerant_json(text), item.get("sentence", ""), item.get("evidence", ""))


def read_candidates(raw: str, item: dict) -> Any:
    ids, reason = id_list(tolerant_json(_body(raw)), item["allowed"], item["tag"] in ("QY", "lifetime"))
    return ids if reason == "OK" else None


def read_change(raw: str, item: dict) -> Any:
    text = _body(raw)
    return {"rows": []} if text.lower() == "none" else None if (rows := P.change_rows(item["tag"], tolerant_json(text), item.get("sentence", ""), item.get("evidence", ""))) is None else {"rows": rows}


@dataclass(frozen=True)
class Stage:
    """How a kind of question is asked: votes per item, attempts per vote, how an answer is read (None if it is invalid), and what holds without a valid one."""

    kind: str
    read: Callable[[str, dict], Any]
    attempts: int = 3
    votes: int = 1
    default: Any = None


#: Attempts and votes of every stage.
STAGES = {s.kind: s for s in (
    Stage("classify", read_yes_no, 3, 1, "NO"), Stage("refine", read_text, 1), Stage("names", read_names, 3), Stage("table", read_table, 5, 3), Stage("arbitrate", read_choice, 3), Stage("fill", read_field, 3, 1, "N/A"), Stage("promote", read_ids, 3, 1, []),
    Stage("table_ocr", read_json_lines, 3), Stage("prop_hits", read_hits, 3, 1, []), Stage("name_hits", read_hits, 3, 1, []), Stage("refine_prop", read_objects, 3), Stage("gate", read_gate, 1, 1, True), Stage("keep_refine", partial(read_checked, "keep_refine"), 3, 1, {"action": "KEEP"}),
    Stage("route", partial(read_checked, "route"), 3, 1, {"decision": "main"}), Stage("bind", read_bound, 3, 1, {"scope": "none", "samples": []}), Stage("rewrite", read_rewrite, 3), Stage("review", partial(read_checked, "review"), 3, 3), Stage("recheck", partial(read_checked, "recheck"), 3, 1, {"keep": False}),
    Stage("structure", read_structure, 5, 3), Stage("choose", read_candidates, 5, 3), Stage("change", read_change, 5, 3),
)}


def ask_items(items: DataFrame, stage: Stage | str, key: list[str], prompt: Column, client: Callable[[list[str]], list[str]] | None = None, recorded: DataFrame | None = None, context: Column | None = None) -> DataFrame:
    """Rows (key, vote_no, answer string as JSON, attempt int, valid boolean), one per item and vote.

    client answers prompts; recorded is a table (prompt_sha, vote_no, attempt, raw) instead. The first valid answer of at most `attempts` holds, else the stage's
    default with attempt 0. Only what has no valid answer yet is asked again. context: a JSON object with what the stage's reader needs of an item.
    """
    stage = STAGES[stage] if isinstance(stage, str) else stage
    ship_package(items.sparkSession)
    told = items.withColumn("_c", F.coalesce(context, F.lit("{}")) if context is not None else F.lit("{}"))
    requests = make_requests(told, stage.kind, [*key, "_c"], prompt, votes=stage.votes)
    read, default = stage.read, json.dumps(stage.default, ensure_ascii=False)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            answers = []
            for raw, told_ in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                try:
                    found = read(raw or "", json.loads(told_))
                except (KeyError, TypeError, ValueError, AttributeError):
                    found = None
                answers.append(None if found is None else json.dumps(found, ensure_ascii=False))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(answers, pa.string())], ["request_id", "attempt", "answer"])

    def judged(responses: DataFrame) -> DataFrame:
        rows = responses.join(requests.select("request_id", "_c"), "request_id").select("request_id", F.col("attempt").cast("int").alias("attempt"), "raw", "_c")
        return rows.mapInArrow(judge, "request_id string, attempt int, answer string").filter("answer is not null")

    if recorded is not None:
        valid = judged(replay(requests, recorded).filter(F.col("attempt") <= stage.attempts))
    else:
        valid, open_ = None, requests
        for attempt in range(1, stage.attempts + 1):
            got = judged(ask(open_, client, attempt))
            valid = got if valid is None else valid.unionByName(got)
            open_ = open_.join(got.select("request_id"), "request_id", "left_anti")
    first = valid.groupBy("request_id").agg(F.min(F.struct("attempt", "answer")).alias("v"))
    out = requests.join(first, "request_id", "left")
    return out.select(*key, "vote_no", F.coalesce("v.answer", F.lit(None if default == "null" else default)).alias("answer"), F.coalesce("v.attempt", F.lit(0)).alias("attempt"), F.col("v").isNotNull().alias("valid"))


def gated(items: DataFrame, gates: list[DataFrame], key: list[str], tag: str) -> DataFrame:
    """Items that no gate's answer (key, answer) denies; chirality passes without being asked."""
    out = items
    for g in gates:
        denied = g.filter("answer = 'false'").select(*key).distinct()
        out = out.filter(F.col(tag).isin("Chiral", "CPL")).unionByName(out.filter(~F.col(tag).isin("Chiral", "CPL")).join(denied, key, "left_anti"))
    return out


def routed(items: DataFrame, answers: DataFrame, key: list[str], tag: str) -> DataFrame:
    """Items with source_kind main, app or vs; dropped ones are left out; properties without numbers, and items without an answer, are main."""
    told = answers.select(*key, F.lower(F.get_json_object("answer", "$.decision")).alias("_d"))
    kind = F.when(F.col(tag).isin("Ex", "Em", "QY", "lifetime"), F.coalesce("_d", F.lit("main"))).otherwise("main")
    return items.join(told, key, "left").withColumn("source_kind", kind).filter("source_kind <> 'drop'").drop("_d")


def filled(rows: DataFrame, answers: DataFrame, key: list[str], column: str) -> DataFrame:
    """Rows whose `column` the answers (key, answer) overwrite, whatever they say."""
    told = answers.select(*key, F.get_json_object(F.concat(F.lit('{"v":'), "answer", F.lit("}")), "$.v").alias("_v"), F.lit(True).alias("_asked"))
    return rows.join(told, key, "left").withColumn(column, F.when(F.col("_asked"), F.col("_v")).otherwise(F.col(column))).drop("_v", "_asked")


def promoted(sentences: DataFrame, answers: DataFrame, document: list[str], sid: str, section: str) -> DataFrame:
    """Sentences of an introduction whose ids an answer names belong to the results; ids of other sections change nothing."""
    ids = answers.select(*document, F.explode(F.from_json("answer", "array<bigint>")).alias(sid)).distinct().withColumn("_up", F.lit(True))
    up = F.coalesce(F.col("_up"), F.lit(False)) & F.col(section).isin("intro", "introduction")
    return sentences.join(ids, [*document, sid], "left").withColumn(section, F.when(up, "results_discussion").otherwise(F.col(section))).drop("_up")


def reviewed(items: DataFrame, votes: DataFrame, key: str) -> DataFrame:
    """Items with verdict, how it was found, and the reason that most of its votes give, the first of equals."""
    v = votes.select(key, "vote_no", F.upper(F.get_json_object("answer", "$.verdict")).alias("verdict"), F.upper(F.get_json_object("answer", "$.reason")).alias("reason"))
    won = verdict_majority(v, key, "verdict")
    reasons = v.filter("reason is not null").groupBy(key, "verdict", "reason").agg(F.count("*").alias("n"), F.min("vote_no").alias("first"))
    reasons = reasons.groupBy(key, "verdict").agg(F.min(F.struct((-F.col("n")).alias("n"), "first", "reason")).alias("r")).select(key, "verdict", F.col("r.reason").alias("reason"))
    return items.join(won, key, "left").join(reasons, [key, "verdict"], "left").withColumn("reason", F.coalesce("reason", F.lit("OTHER")))


def assigned(items: DataFrame, hits: DataFrame, samples: DataFrame, document: str, key: list[str]) -> DataFrame:
    """Items with names: those the answers (key, answer) hit; a document with one sample (document, sample) gives it to all, one without any gives none."""
    one = samples.groupBy(document).agg(F.count_distinct("sample").alias("_n"), F.min("sample").alias("_only"))
    told = hits.select(*key, F.from_json("answer", "array<string>").alias("_h"))
    j = items.join(one, document, "left").join(told, key, "left")
    names = F.when(F.col("_n") == 1, F.array("_only")).when(F.col("_n") > 1, F.coalesce("_h", F.array().cast("array<string>"))).otherwise(F.array().cast("array<string>"))
    return j.withColumn("names", names).drop("_n", "_only", "_h")


def keep_or_refine(items: DataFrame, key: list[str], sentence: str, step: Callable[[DataFrame, int], DataFrame], loops: int = 5) -> DataFrame:
    """Items after at most `loops` rounds of `step`, which gives (key, action, sentence) for the open ones: KEEP ends an item, REFINE gives its next sentence.

    What is still refined after the last round keeps its last sentence, with settled = false.
    """
    open_, done = items.withColumn("settled", F.lit(False)), None
    for k in range(1, loops + 1):
        told = step(open_, k).select(*key, F.upper("action").alias("_a"), F.col("sentence").alias("_s"))
        j = open_.join(told, key, "left")
        keep = F.coalesce(F.col("_a") != "REFINE", F.lit(True)) | F.col("_s").isNull()
        ended = j.filter(keep).withColumn("settled", F.lit(True)).drop("_a", "_s")
        done = ended if done is None else done.unionByName(ended)
        open_ = j.filter(~keep).withColumn(sentence, F.col("_s")).drop("_a", "_s")
    return done.unionByName(open_)
