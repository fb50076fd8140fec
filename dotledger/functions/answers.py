"""Reading model answers: sentinels, decisions, tolerant JSON, id lists. Column functions where Spark can express them, else plain functions that Arrow batches are mapped with."""

from __future__ import annotations

import ast
import json
import re
from typing import Any

from pyspark.sql import Column, functions as F


def strip_thinking(answer: Column, last: bool = True) -> Column:
    """The answer after its last (or first) closing think tag, without a surrounding code fence; unchanged without a tag."""
    tag = "</think>"
    after = F.substring_index(answer, tag, -1) if last else F.when(F.instr(answer, tag) > 0, F.substr(answer, F.instr(answer, tag) + len(tag))).otherwise(answer)
    return F.trim(F.regexp_replace(F.trim(after), "^```[A-Za-z]*\\s*\\n?|\\n?```\\s*$", ""))


def yes_no(answer: Column) -> Column:
    """YES wins wherever it stands; NO otherwise and for null."""
    return F.when(F.coalesce(F.upper(answer).contains("YES"), F.lit(False)), "YES").otherwise("NO")


def tagged(answer: Column, tag: str) -> Column:
    """What stands between <tag> and </tag>, in any case, over lines; null without both."""
    return F.nullif(F.trim(F.regexp_extract(answer, f"(?is)<{tag}>(.*?)</{tag}>", 1)), F.lit(""))


def boolean_answer(answer: Column, default: bool = True) -> Column:
    """{true}, "key": true or a bare word, in this order; the default otherwise."""
    low = F.lower(answer)
    forms = ["\\{\\s*(true|false)\\s*\\}", '"[^"]*"\\s*:\\s*(true|false)', "\\b(true|false)\\b"]
    found = F.coalesce(*(F.nullif(F.regexp_extract(low, p, 1), F.lit("")) for p in forms))
    return F.coalesce(found == "true", F.lit(default))


def body_before(answer: Column, mark: str, required: bool = False) -> tuple[Column, Column]:
    """(text before the end mark, reason): reason is EMPTY, NO_END_MARK, EMPTY_BODY or null."""
    has = F.instr(answer, mark) > 0
    body = F.trim(F.when(has, F.substring_index(answer, mark, 1)).otherwise(answer))
    reason = F.when(F.coalesce(F.trim(answer), F.lit("")) == "", "EMPTY").when(F.lit(required) & ~has, "NO_END_MARK").when(body == "", "EMPTY_BODY")
    return F.when(reason.isNull(), body), reason


def balanced(text: str, opener: str = "{") -> str | None:
    """The first bracketed fragment from `opener` to its partner; brackets within strings don't count."""
    closer = {"{": "}", "[": "]"}[opener]
    start = text.find(opener)
    if start < 0:
        return None
    depth, quoted, escaped = 0, False, False
    for k in range(start, len(text)):
        c = text[k]
        if escaped:
            escaped = False
        elif quoted:
            escaped = c == "\\"
            quoted = c != '"'
        elif c == '"':
            quoted = True
        elif c == opener:
            depth += 1
        elif c == closer:
            depth -= 1
            if not depth:
                return text[start : k + 1]
    return None


def tolerant_json(text: str | None) -> Any:
    """The JSON value of a text: as it is, its first balanced object or array, with stray commas dropped, or as a Python literal. None if nothing fits."""
    if not text or not text.strip():
        return None
    body = re.sub(r"^```\w*\s*|\s*```$", "", text.strip())
    for piece in dict.fromkeys(p for p in (body, balanced(body, "{"), balanced(body, "[")) if p):
        for form in (piece, re.sub(r",\s*([}\]])", r"\1", piece)):
            try:
                return json.loads(form)
            except ValueError:
                pass
        named = re.sub(r"\bnull\b", "None", re.sub(r"\btrue\b", "True", re.sub(r"\bfalse\b", "False", piece)))
        try:
            return ast.literal_eval(named)
        except (ValueError, SyntaxError, MemoryError, RecursionError):
            pass
    return None


def id_list(value: Any, allowed: list[int], two: bool) -> tuple[list[int], str]:
    """(ids, reason) of an answer that names one candidate, or two where that is allowed."""
    if isinstance(value, dict):
        value = next((value[k] for k in ("keep_candidate_ids", "keep_ids", "candidate_ids", "ids", "keep_id", "id") if k in value), None)
    if isinstance(value, (int, float, str)) and not isinstance(value, bool):
        value = re.findall(r"\d+", str(int(value) if isinstance(value, float) else value))
    if not isinstance(value, (list, tuple)):
        return [], "NO_IDS"
    try:
        ids = list(dict.fromkeys(int(x) for x in value))
    except (TypeError, ValueError):
        return [], "NOT_NUMBERS"
    if not ids:
        return [], "EMPTY_IDS"
    if any(i not in allowed for i in ids):
        return [], "UNKNOWN_ID"
    if len(ids) > (2 if two else 1):
        return [], "TOO_MANY"
    return sorted(ids), "OK"
