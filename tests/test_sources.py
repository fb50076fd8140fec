import json

import pytest

from dotledger.functions import answers, latex, segments
from dotledger.operators import boundary
from dotledger.sources import documents, property_markdown, sinks
from dotledger.streaming import incremental
from pyspark.sql import functions as F
from tests.conftest import rows


def test_document_scan(spark, tmp_path):
    for folder, text in (("100_first", "# A\nx"), ("20_second", "y"), ("note", "z")):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "a.md").write_text(text)
    got = documents.scan_documents(spark, str(tmp_path), start_from=50).select("doc_id", "name", "md")
    assert rows(got) == [("100", "first", "# A\nx")]
    assert rows(documents.scan_documents(spark, str(tmp_path), ids=["20"]).select("doc_id")) == [("20",)]


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿id,text\n1,\"a, \"\"b\"\"\"\n2,\n".encode())
    assert rows(documents.read_strict_csv(spark, str(tmp_path / "a.csv"), "id int, text string, extra string", ["id"])) == [(1, 'a, "b"', ""), (2, "", "")]
    with pytest.raises(ValueError):
        documents.read_strict_csv(spark, str(tmp_path / "a.csv"), "id int", ["missing"])
    (tmp_path / "b.csv").write_text("id,text\n1,\"a, b\"\n2,\nx,y\n")
    good, bad = documents.read_tolerant_csv(spark, str(tmp_path / "b.csv"), "id int, text string")
    assert [tuple(r) for r in good.collect()] == [(1, 'a, b'), (2, None)] and [r['line'] for r in bad.collect()] == ['x,y']
    out = str(tmp_path / "out")
    sinks.write_csv(spark.createDataFrame([(1, None)], "a int, b string"), out)
    assert spark.read.option("header", True).csv(out).first() == ("1", "N/A")


def test_text_tables(spark):
    html = "<p><table><tr><th>a</th><th>b</th></tr><tr><td>1 <b>x</b></td></tr></table> <table></table>"
    df = spark.createDataFrame([("d", html), ("e", None), ("f", "no table")], "doc string, t string")
    assert rows(documents.html_tables(df, "doc", "t")) == [("d", 0, 0, ["a", "b"]), ("d", 0, 1, ["1 x", ""])]
    cells = " | ".join(f"c{i}" for i in range(10))
    md = f"### Extraction 1\n\n| {' | '.join('h' * 10)} |\n|{'---|' * 10}\n| {cells} |\n| short | row |\n\n### Extraction 2\nnothing\n"
    got = documents.extraction_tables(spark.createDataFrame([("d", md)], "doc string, t string"), "doc", "t").collect()
    assert [tuple(r)[:4] for r in got] == [("d", 1, 0, "c0")] and got[0]["Purification"] == "c9"
    chunks = "[Para 1, Tokens: 5]\nfirst text\n---\n[Para 2, Tokens: 7]\nsecond\n"
    assert rows(documents.chunk_markdown(spark.createDataFrame([("d", chunks)], "doc string, t string"), "doc", "t")) == [("d", 1, 5, "first text"), ("d", 2, 7, "second")]


def test_notes_round_trip(spark):
    md = "## CD-1 (MAIN)\n1. [para=3; window=SMALL; sids=4,5]\n> It glows.\n- QY: It is 20 %.\n- Em: At 450 nm.\n\n## Step 2\n1. [para=1; window=SMALL; sids=1]\n- QY: dropped\n"
    items = property_markdown.read_notes(spark.createDataFrame([("d", md), ("e", None)], "doc string, md string"), "doc", "md")
    assert rows(items.select("sample", "para_id", "window_sids", "tag", "sentence")) == [("CD-1", 3, [4, 5], "Em", "At 450 nm."), ("CD-1", 3, [4, 5], "QY", "It is 20 %.")]
    again = property_markdown.read_notes(property_markdown.write_notes(items, "doc"), "doc", "md")
    assert rows(again.drop("tag_order")) == rows(items.drop("tag_order"))


def test_answers(spark):
    assert answers.tolerant_json('text {"a": [1, 2,], "b": "}"} tail') == {"a": [1, 2], "b": "}"}
    assert answers.tolerant_json("{'a': None, 'b': true}") == {"a": None, "b": True}
    assert answers.tolerant_json("nothing") is None and answers.tolerant_json(None) is None
    assert answers.balanced('x {"k": "a\\"}"} y') == '{"k": "a\\"}"}'
    assert answers.id_list({"keep_ids": [2, 1]}, [1, 2], True) == ([1, 2], "OK") and answers.id_list({"id": 3}, [1], False)[1] == "UNKNOWN_ID" and answers.id_list([1, 2], [1, 2], False)[1] == "TOO_MANY"
    df = spark.createDataFrame([("<think>x</think>```json\nYES\n```",), ("no <V> a </V>",), ("{false}",), (None,)], "a string")
    a = F.col("a")
    got = df.select(answers.strip_thinking(a), answers.yes_no(a), answers.tagged(a, "v"), answers.boolean_answer(a)).collect()
    assert got[0][0] == "YES" and [r[1] for r in got] == ["YES", "NO", "NO", "NO"] and got[1][2] == "a" and [r[3] for r in got] == [True, True, False, True]
    body, reason = answers.body_before(a, "<V>", required=True)
    assert [tuple(r) for r in df.select(body, reason).collect()][1:] == [("no", None), (None, "NO_END_MARK"), (None, "EMPTY")]


def test_latex_and_segments(spark):
    df = spark.createDataFrame([("it was then heated to $180^{\\circ}C$ with 5 $\\mathrm{mL}$ of water",), ("\\alpha and 10\\%",), ("\\begin{x}",)], "l string")
    assert [r[0] for r in df.select(latex.convert_line(F.col("l"))).collect()][:2] == ["it was then heated to 180°C with 5 mL of water", "αand 10%"]
    assert segments.merge_short_pieces(["A long first sentence here.", "(see Fig. 1)", "[3] Next one is long enough now."]) == ["A long first sentence here. (see Fig. 1) [3] Next one is long enough now."]
    assert segments.merge_short_heads(["1.", "Introduction to dots", "It begins here."]) == ["1. Introduction to dots It begins here."]
    assert segments.merge_orphans(["Found by Li et al.", "[3] and others.", "of the dots"]) == ["Found by Li et al. [3] and others. of the dots"]
    assert segments.balanced_items("A (1 g, dry); B") == ["A (1 g, dry)", "B"]
    assert segments.wrap("carbon dots from citric acid", 12) == ["carbon dots", "from citric", "acid"]


def test_boundary(spark):
    df = spark.createDataFrame([("d", 1, "p"), ("d", 2, "p"), ("e", 1, "q")], "doc string, item int, prompt string")
    req = boundary.make_requests(df, "classify", ["doc", "item"], F.col("prompt"), votes=2)
    assert req.count() == 6 and req.select("request_id").distinct().count() == 6
    first = boundary.ask(req, lambda texts: ["bad" if t == "q" else "YES" for t in texts])
    good = boundary.first_valid(first, F.col("raw") == "YES", most=3)
    assert good.count() == 4 and boundary.unanswered(req, good).count() == 2


def test_incremental(spark, tmp_path):
    source, target, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    spark.createDataFrame([(1, "a")], "id int, t string").coalesce(1).write.parquet(source)
    run = lambda: incremental.run_new_files(spark, source, "id int, t string", lambda d: d.withColumn("n", F.length("t")), target, check).awaitTermination(60)
    run()
    run()
    assert spark.read.parquet(target).count() == 1
    spark.createDataFrame([(2, "bb")], "id int, t string").coalesce(1).write.mode("append").parquet(source)
    run()
    assert rows(spark.read.parquet(target).select("id", "n")) == [(1, 1), (2, 2)]
    done = spark.createDataFrame([("1", "h", "s")], "doc_id string, input_hash string, stage string")
    docs = spark.createDataFrame([("1", "h"), ("1", "changed"), ("2", "h")], "doc_id string, input_hash string")
    assert rows(incremental.pending(docs, done, "s")) == [("1", "changed"), ("2", "h")]


def test_review_items(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"doc_id": "1", "items": [{"cd_name": "x", "column": "Time", "reason": "NA", "current_value": "N/A", "raw_values": ["1 h"]}]}))
    (tmp_path / "b.json").write_text("not json")
    got = documents.read_review_items(spark, str(tmp_path / "*.json"))
    assert rows(got.select("doc_id", "cd_name", "status")) == [("1", "x", "ok"), (None, None, "error")]
