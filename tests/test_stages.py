"""Answers of models: reading, validation, votes and what becomes of them; tables and notes."""

import json
import random

import pytest
from pyspark.sql import functions as F

from dotledger.functions import answers, measures as M, payloads as P, tables as T
from dotledger.functions.rules import TABLE_COLUMNS
from dotledger.operators import model_stages as S, structured as D
from dotledger.sources import documents, structured_notes as N
from tests.conftest import rows


@pytest.mark.parametrize("text, expected", [('x {"a":"x\\\\\\"}"} y', '{"a":"x\\\\\\"}"}'), ('{"a":"x\\\\"} y}', '{"a":"x\\\\"}'), ('{"a": "}", "b": {"c": 1}} z', '{"a": "}", "b": {"c": 1}}'), ("none", None), ('{"a"', None)])
def test_balanced(text, expected):
    assert answers.balanced(text) == expected


@pytest.mark.parametrize("tag, payload, sentence, evidence, expected", [
    ("Chiral", {"tag": "chiral", "label": "yes"}, "", "", {"tag": "Chiral", "label": "YES"}), ("Chiral", [{"tag": "Chiral", "label": "maybe"}], "", "", None), ("Em", {"tag": "Em", "values": "450 nm"}, "", "", {"tag": "Em", "values": [450.0], "unit": "nm", "vary_by": "", "vary_values": []}),
    ("QY", {"tag": "QY", "values": [0.12]}, "a yield of 0.12", "it was 12 %", {"tag": "QY", "values": [12.0], "unit": "%", "vary_by": "", "vary_values": []}), ("QY", {"tag": "QY", "values": [0.12]}, "0.12 %", "", {"tag": "QY", "values": [0.12], "unit": "%", "vary_by": "", "vary_values": []}),
    ("lifetime", {"tag": "lifetime", "values": [5], "unit": "ms", "vary_by": "components", "vary_values": ["t1"]}, "5 ns", "", {"tag": "lifetime", "values": [5.0], "unit": "ns", "vary_by": "component", "vary_values": ["t1"]}), ("Em", {"tag": "Em", "values": [1], "vary_by": "tau"}, "", "", None),
    ("Em", [{"tag": "Em", "values": [1]}], "", "", None), ("Em", [{"tag": "Em", "values": [450], "vary_by": "excitation wavelength", "vary_values": ["365 nm"]}], "", "", [{"tag": "Em", "values": [450.0], "unit": "nm", "vary_by": "Ex", "vary_values": [365.0]}]), ("Em", {"tag": "Em", "values": [True]}, "", "", None), ("Em", None, "", "", None),
])
def test_structured_values(tag, payload, sentence, evidence, expected):
    assert P.structured_value(tag, payload, sentence, evidence) == expected


def test_change_rows():
    row = lambda v, by, c: {"tag": "QY", "values": v, "unit": "%", "vary_by": by, "vary_values": c}
    assert P.change_rows("QY", {"rows": [{"values": [10, 20], "vary_by": "ph", "vary_values": [3, "7"]}]}) == [row(10.0, "pH", 3.0), row(20.0, "pH", 7.0)]
    assert P.change_rows("QY", [{"value": 10, "vary_by": "solvent", "vary_value": " dry  water"}, {"value": 20, "vary_by": "solvent", "vary_value": "DMF"}])[0]["vary_values"] == "dry water"
    assert P.change_rows("QY", {"none": True}) == [] and P.change_rows("QY", "x") is None
    for bad in ([{"values": [10], "vary_by": "pH", "vary_values": [3]}], [{"values": [10, 20], "vary_by": "pH", "vary_values": 3}], [{"values": [10, 10], "vary_by": "pH", "vary_values": [3, 4]}], [{"values": [1, 2, 3], "vary_by": "pH", "vary_values": [3, 4]}], [{"values": [1, 2], "vary_by": "size", "vary_values": [3, 4]}], [{"tag": "Em", "values": [1, 2], "vary_by": "pH", "vary_values": [3, 4]}]):
        assert P.change_rows("QY", bad) is None, bad
    assert P.change_rows("lifetime", [{"values": [1, 2], "vary_by": "Em", "vary_values": [450, 500], "unit": "parsec"}]) is None


def test_kinds_and_objects():
    e = lambda kind, *ids: {"kind": kind, "evidence": list(ids)}
    assert P.kind_conflicts([e("main", 1, 2), e("vs", 1), e("app", 3)]) == [e("vs", 1), e("app", 3)] and P.kind_conflicts([e("vs", 1), e("vs", 1, 2), e("main", 1)]) == [e("vs", 1), e("vs", 1, 2)] and P.kind_conflicts([e("main", 1, 2), e("vs", 2, 3)]) == [e("main", 1, 2), e("vs", 2, 3)]
    texts = {4: "It emits at 450 nm.", 5: "Other."}
    ok = {"kind": "main", "sample": "", "Property": {"Em": "CD-1 emits at 450 nm."}, "evidence": [4, 9]}
    assert P.refined_objects([ok, ok, {"kind": "false"}], "CD-1", "Em", [4, 5], texts) == [{"kind": "main", "sample": "CD-1", "evidence": [4], "Property": {"Em": "CD-1 emits at 450 nm."}}]
    assert P.refined_objects([ok | {"Property": {"Em": "at 460 nm"}}], "CD-1", "Em", [4, 5], texts) == [] and P.refined_objects([{"kind": "false"}], "x", "Em", [], {}) == [{"kind": "false"}] and P.refined_objects(None, "x", "Em", [], {}) is None
    assert P.refined_objects([ok | {"sample": "CD-2"}], "CD-1", "Em", [4], texts) == []


def test_payload_errors():
    assert P.payload_error("review", {"verdict": "keep", "reason": "x"}) is None and P.payload_error("review", {"verdict": "keep"}) == "MISSING_REASON" and P.payload_error("route", {"decision": "up"}) == "INVALID_DECISION" and P.payload_error("bind", {"scope": "none", "samples": "x"}) == "INVALID_SAMPLES"
    assert P.payload_error("recheck", {}) == "MISSING_KEEP" and P.payload_error("recheck", {"keep": "{true}"}) is None and P.payload_error("recheck", {"keep": "perhaps"}) == "INVALID_KEEP" and P.payload_error("rewrite", {"sentence": 5}) == "INVALID_SENTENCE" and P.payload_error("keep_refine", {"action": "refine", "candidates": 3}) == "INVALID_CANDIDATES" and P.payload_error("route", []) == "NOT_AN_OBJECT"
    assert P.bound_names({"scope": "single"}, ["a"]) == ("single", ["a"]) and P.bound_names({"scope": "multi", "samples": ["b", "x"]}, ["a", "b"]) == ("single", ["b"]) and P.bound_names({"scope": "family", "samples": ["a"]}, ["a"]) == ("family", ["a"])
    assert P.rewritten("CD-1 emits.", "CD-1") == ("CD-1 emits.", "OK") and P.rewritten("none.", "CD-1") == (None, "NONE") and P.rewritten("It emits.", "CD-1")[1] == "SAMPLE_NOT_NAMED"


def test_number_units(spark):
    df = spark.createDataFrame([("emits at 450-460 nm with 12 % yield",), ("τ of 5.2 ns, 3 us and 7 ms after 10 s; 5.2 ns",), ("no number, percent",), ("",), (None,)], "t string")
    got = df.select(M.number_units(F.col("t")).alias("p"), M.unit_mask(F.col("t")).alias("u")).collect()
    assert [tuple(x) for x in got[0]["p"]] == [("450-460", "nm"), ("460", "nm"), ("12", "%"), ("450", "")] and got[0]["u"] == ["nm", "%"]
    assert [tuple(x) for x in got[1]["p"]] == [("5.2", "ns"), ("3", "μs"), ("7", "ms"), ("10", "s")] and got[2]["u"] == ["%"] and got[3]["p"] == [] and got[4]["p"] is None


def test_contained_values_like_the_ordered_rule(spark):
    rng = random.Random(8)
    data = [(g, k, [float(rng.randrange(5)) for _ in range(rng.randint(0, 4))]) for g in range(40) for k in range(8)]
    expected = []
    for g in range(40):
        sets = {k: set(v) for h, k, v in data if h == g and v}
        gone = set()
        for k in sorted(sets):
            into = next((j for j in sorted(sets) if j != k and j not in gone and sets[k] < sets[j]), None)
            if into is not None:
                gone.add(k)
                expected.append((g, k, into))
    df = spark.createDataFrame([*data, (None, 1, [1.0]), (None, 2, [1.0, 2.0]), (3, 99, None)], "g int, k int, v array<double>")
    assert rows(D.contained_values(df, ["g"], "k", "v")) == sorted([*expected, (None, 1, 2)], key=repr)


ROW = ["CD-1", "hydrothermal", "180 °C", "5 h", "N/A", "citric acid", "citric acid (1 g)", "water", "water (10 mL)", "N/A"]


def _table(*body):
    line = lambda r: "| " + " | ".join(r) + " |"
    return "\n".join([line(TABLE_COLUMNS), "|" + "---|" * len(TABLE_COLUMNS), *map(line, body)])


def test_tables(spark):
    good = _table(ROW)
    assert T.pipe_table(f"| a | b |\n\n{good}\ntext") == [TABLE_COLUMNS, ROW] and T.pipe_table(good + "\n| short |") == []
    parsed = T.pipe_table(good)
    codes = [T.table_error(*x) for x in (([], []), ([["x"]], []), (parsed, []), (parsed, ["CD-2"]), (parsed, ["**CD-1**"]))]
    assert [c and c.code for c in codes] == ["empty_rows", "header_check", "row_count_mismatch", "name_order_check_strip", None]
    bad = [TABLE_COLUMNS, [*ROW[:6], "1 g", *ROW[7:]]]
    assert T.table_error(bad, ["CD-1"]) == T.TableError("amount_format", "Precursor_Amount", "CD-1", 1, "1 g", "citric acid")
    assert T.patched(bad, [{"row_name": "`CD-1`", "column": "Precursor_Amount", "value": "citric acid (1 g)"}], ["CD-1"]) == ([TABLE_COLUMNS, ROW], "OK") and T.patched(bad, [{"row_name": "CD-1", "column": "Time", "value": "x"}], ["CD-1"])[1] == "COLUMN" and T.patched(bad, [{"row_name": "z", "column": "Solvent_Volume"}], ["CD-1"])[0] is None
    df = spark.createDataFrame([("d", good), ("e", good + "\n| short |"), ("f", None)], "doc string, t string")
    assert [tuple(r)[:3] for r in documents.valid_tables(df, "doc", "t").collect()] == [("d", 0, "CD-1")]


def test_names_and_abbreviations(spark):
    assert T.canonical_names("**CDs_Name**: `N-CDs`\nCDs name - n cds\nother: x\nCDs Name: B-CDs") == ["N-CDs", "B-CDs"]
    text = "We used citric acid (CA) and EDA (ethylenediamine, dry).\na longer-than-twelve-letters (no acronym here) and (unclosed"
    assert [x[:2] for x in T.abbreviations(text)] == [("ca", "we used citric acid"), ("eda", "ethylenediamine, dry")] and T.abbreviations("") == []
    assert T.first_bracket("a (b (c) d) e") == (2, 10) and T.first_bracket("a )(") == (-1, -1)
    assert T.mapped_entities("CA (dry), water; EDA", {"ca": "citric acid", "eda": "x"}, {"eda"}) == "citric acid (dry), water, EDA" and T.mapped_quantities("CA (1 g), EDA (2 mL)", {"ca": "citric acid"}, set()) == "citric acid (1 g), EDA (2 mL)" and T.mapped_quantities("CA", {}, set()) == "N/A"
    df = spark.createDataFrame([(1, text), (2, None), (1, text)], "id bigint, t string")
    assert rows(documents.abbreviation_scan(df, "id", "t").select("id", "pos", "short")) == [(1, 0, "ca"), (1, 0, "ca"), (1, 1, "eda"), (1, 1, "eda")]


NOTES = """# Paper
## CD-1 (MAIN)
1. [para=3; window=SMALL; sids=4,5]
> It glows.
Property abstract:
[A]QY: It is 20 %.
[B]QY: It is 30 %.
Em: At 450 nm.
Structured:
QY: {"tag":"QY","values":[20.0],"unit":"%"}
[B]QY: {"tag":"QY","values":[30.0],"unit":"%","x":1}
Em: {'tag': 'Em', 'values': [450.0], 'unit': 'nm'}
kept as it is
2. [change]
A. [para=1; window=EXTENDED; sids=1]
> one
B. [para=2; window=SMALL; sids=2]
> two
Property abstract:
QY: It changes.
## Step 5
## CD-2
3. not a head
Property abstract:
QY: x
"""


def test_structured_notes(spark):
    a = N.parse_structured(NOTES)
    assert [(e.sample, e.number, e.change, len(e.blocks), len(e.lines)) for e in a] == [("CD-1", 1, False, 1, 3), ("CD-1", 2, True, 2, 1), ("CD-2", 3, False, 1, 1)]
    assert [(x.prefix, x.tag, (x.value or {}).get("values")) for x in a[0].lines] == [("[A]", "QY", [20.0]), ("[B]", "QY", [30.0]), ("", "Em", [450.0])] and a[0].tail == ["kept as it is"] and a[0].blocks[0]["sids"] == [4, 5] and a[1].blocks[1]["text"] == "two"
    b = N.parse_structured(NOTES, strict=True)
    assert [e.number for e in b] == [1, 2] and "x" not in b[0].lines[1].value
    shown = lambda es: [(e.sample, e.change, [(x.prefix, x.tag, x.sentence, x.value or None) for x in e.lines], e.tail, e.blocks) for e in es]
    again = N.parse_structured(N.render_structured(a))
    assert shown(again) == shown(a) and [e.number for e in again] == [1, 2, 1]
    refined = N.parse_refined("## CD-1\n1. [para=3; win=SMALL; sids=4]\nEvidence:\nIt glows.\nRefined properties:\nQY: first\nEm: x\nQY: last\n")
    assert [(x.tag, x.sentence) for x in refined[0].lines] == [("QY", "last"), ("Em", "x")] and refined[0].blocks[0]["text"] == "It glows."
    df = spark.createDataFrame([("d", NOTES), ("e", None), ("f", "")], "doc string, md string")
    got = N.read_structured(df, "doc", "md")
    assert got.count() == 5 and rows(got.filter("entry = 1 and prefix = '[A]'").select("win_level", "window_sids", "evidence", "structured")) == [("SMALL", [4, 5], "It glows.", '{"tag": "QY", "values": [20.0], "unit": "%"}')]


def test_asking_until_valid(spark, tmp_path):
    items = spark.createDataFrame([("d", 1, "good"), ("d", 2, "late"), ("d", 3, "never")], "doc string, item int, p string")
    later = tmp_path / "later"

    def client(texts):
        return ["YES" if t == "good" or t == "late" and later.exists() else "?" for t in texts]

    first = S.ask_items(items, S.Stage("classify", S.read_yes_no, 1, 1, "NO"), ["doc", "item"], F.col("p"), client)
    assert rows(first.select("item", "answer", "attempt", "valid")) == [(1, '"YES"', 1, True), (2, '"NO"', 0, False), (3, '"NO"', 0, False)]
    later.touch()
    assert rows(S.ask_items(items, "classify", ["doc", "item"], F.col("p"), client).select("item", "answer")) == [(1, '"YES"'), (2, '"YES"'), (3, '"NO"')]


def test_recorded_answers(spark):
    from dotledger.operators.boundary import make_requests

    items = spark.createDataFrame([(k, "ask") for k in range(2)], "item int, p string")
    req = make_requests(items, "review", ["item"], F.col("p"), votes=3)
    sha = req.first()["prompt_sha"]
    raw = [(sha, 1, 1, "junk"), (sha, 1, 2, '{"verdict": "keep", "reason": "ok"}'), (sha, 2, 1, '{"verdict": "REWRITE", "reason": "b"}'), (sha, 3, 1, '{"verdict": "rewrite", "reason": "a"}'), (sha, 3, 9, '{"verdict": "drop", "reason": "a"}')]
    recorded = spark.createDataFrame(raw, "prompt_sha string, vote_no int, attempt int, raw string")
    votes = S.ask_items(items, "review", ["item"], F.col("p"), recorded=recorded)
    assert rows(votes.filter("item = 0").select("vote_no", "attempt", "valid")) == [(1, 2, True), (2, 1, True), (3, 1, True)]
    assert rows(S.reviewed(items, votes, "item").select("item", "verdict", "how", "reason")) == [(0, "REWRITE", "majority", "B"), (1, "REWRITE", "majority", "B")]


READERS = [
    ("arbitrate", "<Decision>merge</Decision><Value> a </Value>", {}, {"decision": "MERGE", "value": "a"}), ("arbitrate", "<decision>SAME</decision>", {}, None), ("fill", '{"Time": ""}', {"field": "Time"}, "N/A"), ("fill", "{}", {"field": "Time"}, None), ("promote", '{"ids": [1, "2", 9]}', {"allowed": [1, 2]}, [1, 2]),
    ("table_ocr", '{"a": 1}\nx\n{"b": 2}', {}, [{"a": 1}, {"b": 2}]), ("prop_hits", '["QY", "no"]', {"options": ["Em", "QY"]}, ["QY"]), ("gate", "unclear", {}, True), ("gate", "{false}", {}, False), ("bind", '{"scope": "single", "samples": ["a", "b"]}', {"candidates": ["a", "b"]}, {"scope": "multi", "samples": ["a", "b"]}),
    ("rewrite", '{"sentence": "CD-1 glows."}<END_OF_JSON>', {"sample": "CD-1"}, "CD-1 glows."), ("structure", "none", {"tag": "QY"}, {"none": True}), ("choose", '{"keep_ids": [1, 2]}', {"allowed": [1, 2], "tag": "QY"}, [1, 2]), ("choose", '{"keep_ids": [1, 2]}', {"allowed": [1, 2], "tag": "Em"}, None), ("change", "none", {"tag": "QY"}, {"rows": []}),
    ("refine", "<think>x</think> text ", {}, "text"), ("names", "CDs_Name: A", {}, ["A"]), ("table", _table(ROW), {"names": ["CD-1"]}, [TABLE_COLUMNS, ROW]), ("table", _table(ROW), {"names": ["x"]}, None), ("route", '{"decision": "vs"}', {}, {"decision": "vs"}), ("keep_refine", '{"action": "x"}', {}, None), ("recheck", '{"keep": true}', {}, {"keep": True}),
    ("refine_prop", '[{"kind": "main", "Property": {"Em": "at 5 nm"}, "evidence": [1]}]', {"sample": "s", "tag": "Em", "allowed": [1], "texts": {"1": "5 nm"}}, [{"kind": "main", "sample": "s", "evidence": [1], "Property": {"Em": "at 5 nm"}}]),
]


@pytest.mark.parametrize("kind, raw, item, expected", READERS)
def test_reading_answers(kind, raw, item, expected):
    assert S.STAGES[kind].read(raw, item) == expected


def test_what_becomes_of_answers(spark):
    items = spark.createDataFrame([("d", 1, "QY", "intro", "a"), ("d", 2, "Chiral", "results", "b"), ("d", 3, "Em", "intro", "c")], "doc string, item int, tag string, section string, value string")
    told = lambda xs: spark.createDataFrame([("d", k, json.dumps(x)) for k, x in xs], "doc string, item int, answer string")
    key = ["doc", "item"]
    assert rows(S.gated(items, [told([(1, True), (2, False)]), told([(3, False)])], key, "tag").select("item")) == [(1,), (2,)]
    assert rows(S.routed(items, told([(1, {"decision": "VS"}), (2, {"decision": "drop"}), (3, {"decision": "drop"})]), key, "tag").select("item", "source_kind")) == [(1, "vs"), (2, "main")]
    assert rows(S.filled(items, told([(1, "N/A")]), key, "value").select("item", "value")) == [(1, "N/A"), (2, "b"), (3, "c")]
    assert rows(S.promoted(items, spark.createDataFrame([("d", "[1, 2]")], "doc string, answer string"), ["doc"], "item", "section").select("item", "section")) == [(1, "results_discussion"), (2, "results"), (3, "intro")]
    two = spark.createDataFrame([("d", "x"), ("d", "y")], "doc string, sample string")
    hits = told([(1, ["y"])])
    assert rows(S.assigned(items, hits, two, "doc", key).select("item", "names")) == [(1, ["y"]), (2, []), (3, [])] and rows(S.assigned(items, hits, two.limit(1), "doc", key).select("names").distinct()) == [(["x"],)] and rows(S.assigned(items, hits, two.limit(0), "doc", key).select("names").distinct()) == [([],)]
    step = lambda open_, k: open_.select("doc", "item", F.when(F.col("item") == k, "KEEP").otherwise("REFINE").alias("action"), F.concat("value", F.lit("!")).alias("sentence"))
    assert rows(S.keep_or_refine(items, key, "value", step, 2).select("item", "value", "settled")) == [(1, "a", True), (2, "b!", True), (3, "c!!", False)]
