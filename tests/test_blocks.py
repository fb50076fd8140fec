import pytest
from pyspark.sql import functions as F

from dotledger.functions import boundaries as B, segments as G
from dotledger.operators import blocks
from tests.conftest import rows

P = G.Piece
IMG = "![](a.png)"


def test_blocks_of_markdown(spark):
    md = "front matter\n\n# 2. Experimental section\nText one.\n## Detail\nmore\n# 2.1 Cooking\nx\n# 3. Results\n# 2.2 Odd\ny\n#nohead\n# Conclusions\n"
    df = spark.createDataFrame([("d", md), ("e", None), ("f", ""), ("g", "no heading")], "doc string, md string")
    got = blocks.markdown_blocks(df, "doc", "md")
    assert rows(got.select("doc", "block_id", "main_section_norm", "main_header_text", "text", "header_line", "start_line", "end_line")) == sorted([
        ("d", 0, "unknown", "", "front matter", None, 0, 1), ("d", 1, "methods", "2. Experimental section", "2. Experimental section\n\nText one.\n\nDetail\n\nmore", 2, 2, 5), ("d", 2, "methods", "2.1 Cooking", "2.1 Cooking\n\nx", 6, 6, 7),
        ("d", 3, "results_discussion", "3. Results", "3. Results", 8, 8, 8), ("d", 4, "unknown", "2.2 Odd", "2.2 Odd\n\ny\n#nohead", 9, 9, 11), ("d", 5, "conclusion", "Conclusions", "Conclusions", 12, 12, 12), ("g", 0, "unknown", "", "no heading", None, 0, 0),
    ], key=repr)
    assert [r["main_header_text"] for r in blocks.markdown_blocks(df, "doc", "md", drop_front=True).filter("doc = 'd'").orderBy("block_id").collect()][0] == "2. Experimental section"
    assert blocks.markdown_blocks(df, "doc", "md", drop_front=True).filter("doc = 'g'").count() == 1


def test_figures_take_their_captions():
    text = f"A full stop.\n\nUnfinished line\n{IMG}\nFig. 1. Caption.\n\n(a) panel\n\nThe text goes on after the figure with more than twelve words in a long line of it.\n\nEnd."
    assert G.figure_paragraphs(text) == [P("A full stop."), P(f"Unfinished line \n{IMG} \nFig. 1. Caption. \n(a) panel", True), P("The text goes on after the figure with more than twelve words in a long line of it."), P("End.")]
    assert G.figure_paragraphs(f"Stop.\n{IMG}\n\n{IMG}\n\nshort tail") == [P("Stop."), P(f"{IMG} \n{IMG} \nshort tail", True)]
    assert G.figure_paragraphs("") == []


def test_segments():
    text = f"One line\nand more.\n<table><tr><td>x</td></tr></table>\n{IMG}\ncaption\n\nlast"
    assert G.figure_segments(text) == [P("One line and more.", False, 1), P("<table><tr><td>x</td></tr></table>", True, 2), P(f"{IMG} caption", True, 3), P("last", False, 4)]


@pytest.mark.parametrize("rule, pieces, expected", [
    (G.merge_short_heads, [P("2. Results"), P("They glow.")], [P("2. Results They glow.")]), (G.merge_short_heads, [P("They glow."), P("x")], [P("They glow."), P("x")]), (G.merge_short_heads, [P("short"), P("fig", True)], [P("short"), P("fig", True)]),
    (G.merge_heads_across_figures, [P("as shown"), P("f", True), P("It is"), P("x.")], [P("as shown It is x."), P("f", True)]), (G.merge_heads_across_figures, [P("Done."), P("f", True), P("New.")], [P("Done."), P("f", True), P("New.")]),
    (G.merge_heads_across_figures, [P("Done."), P("f", True), P("and more")], [P("Done. and more"), P("f", True)]), (G.merge_tails_around_figures, [P("Before it."), P("f", True), P("g", True), P("a tail")], [P("Before it. a tail"), P("f", True), P("g", True)]),
    (G.merge_tails_around_figures, [P("f", True), P("a tail")], [P("f", True), P("a tail")]), (G.merge_orphans, [P("By Li et al."), P("[3] It was.")], [P("By Li et al. [3] It was.")]), (G.merge_orphans, [P("That is, e.g."), P("This one is long enough here.")], [P("That is, e.g. This one is long enough here.")]),
    (G.merge_orphans, [P("It ended."), P("then a lower-case start of many words here.")], [P("It ended. then a lower-case start of many words here.")]), (G.merge_orphans, [P("It ended."), P("A short one.")], [P("It ended."), P("A short one.")]), (G.merge_orphans, [P("It ended?"), P("5 nm wide.")], [P("It ended? 5 nm wide.")]),
])
def test_merging(rule, pieces, expected):
    assert [(p.text, p.figure) for p in rule(pieces)] == [(p.text, p.figure) for p in expected]


def test_titles_stay_alone():
    assert G.merge_short_heads([P("Results"), P("They glow.")], title="results") == [P("Results"), P("They glow.")] and G.merge_orphans([P("Results"), P("and more")], title="Results") == [P("Results"), P("and more")]


def test_chain(spark):
    md = f"# 1. Results\nThe dots (Fig. 2.) were found by Li et al. They glow.[3]It works. Yes it does indeed work.\n\n{IMG}\nFig. 1. A caption.\n"
    df = spark.createDataFrame([("d", md), ("e", None), ("f", "  ")], "doc string, md string")
    got = blocks.document_sentences(df, "doc", "md").orderBy("sent_global_id").collect()
    assert [(r["para_global_id"], r["sent_id_in_para"], r["sent_global_id"], r["is_figure"], r["text"]) for r in got] == [
        (1, 1, 1, False, "1. Results"), (2, 1, 2, False, "The dots (Fig. 2.) were found by Li et al. They glow. [3]It works."), (2, 2, 3, False, "Yes it does indeed work."), (3, 1, 4, True, f"{IMG} \nFig. 1. A caption."),
    ]
    assert {r["main_section_norm"] for r in got} == {"results_discussion"}
    more = spark.createDataFrame([("d", "front\n# Results\n" + " ".join(f"Sentence number {k} is here." for k in range(10)) + f"\n{IMG}\n\nThe end of it comes now [1, 2]. See Fig. S1. Some of it is shown there.")], "doc string, md string")
    got = blocks.document_sentences(more, "doc", "md", by_segments=True).orderBy("sent_global_id").collect()
    assert [r["para_global_id"] for r in got] == [1] * 8 + [2] * 2 + [3] + [4] * 2 and got[0]["text"] == "Results Sentence number 0 is here." and got[-1]["text"].startswith("See Fig. S1. Some of it") and got[-2]["text"].endswith("[1, 2].")


def test_boundary_columns(spark):
    df = spark.createDataFrame([("Found by Li et al. [3] in Fig. 2. of it, etc. (Eq. (5))",)], "t string")
    kept = B.restore_abbreviations(B.protect_abbreviations(F.col("t")))
    assert df.select(kept).first()[0] == "Found by Li et al. [3] in Fig. 2. of it, etc. (Eq. (5))" and B.MARK in df.select(B.protect_abbreviations(F.col("t"))).first()[0]
    names = spark.createDataFrame([("**`N-CDs`**",), ("_x_",), ("“CD 1”",)], "t string")
    assert [r[0] for r in names.select(B.bare_name(F.col("t"))).collect()] == ["N-CDs", "x", "CD 1"]
    full = spark.createDataFrame([("We used the well known one two three four five citric acid ].",)], "t string")
    assert full.select(B.full_name(F.col("t"))).first()[0] == "known one two three four five citric acid"
