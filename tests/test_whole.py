"""Queries that do more than the SQL of their namesakes."""

from dotledger.operators.consolidation import merge_destinations
from dotledger.plans import consolidation_queries as Q, rule_queries
from tests.conftest import rows

SENTENCES = "sent_uid bigint, pdf_name string, para_global_id int, sent_global_id int, main_section_norm string, LLM_props string, LLM_name string, text string"


def _sentences(spark, folder, data):
    spark.createDataFrame(data, SENTENCES).coalesce(1).write.mode("overwrite").parquet(f"{folder}/decisions.parquet")
    return str(folder)


def test_candidate_samples_fall_back_to_all(spark, tmp_path):
    names = [("d", 1, "CD-1"), ("d", 1, "cd 2"), ("d", 2, "CD1"), ("d", 3, None), ("d", None, "other"), ("e", 1, "CD-1"), ("f", 1, "A.1"), ("f", 1, "x")]
    folder = _sentences(spark, tmp_path, [(k, d, p, k, "results", None, n, "x") for k, (d, p, n) in enumerate(names)])
    table = [("d", "CD-1"), ("d", "CD-1"), ("d", "CD-2"), ("d", "CD-3"), ("f", "A1"), ("f", "a-1"), ("e", "N/A"), (None, "CD-1")]
    spark.createDataFrame(table, "doc_id string, CDs_Naming_in_Paper string").write.parquet(f"{folder}/letter_table.parquet")
    got = rows(Q.candidate_samples_whole(spark, folder))
    assert got == sorted([("d", 1, "matched", ["CD-1", "CD-2"]), ("d", 2, "all", None), ("d", 3, "all", None), ("d", None, "all", None), ("f", 1, "matched", ["A1", "a-1"])], key=repr)


CELLS = ["['Ex', 'QY']", '"Ex","QY"', "Ex QY", "Ex;QY", None, "", "lifetime"]


def test_tags_of_cells_packed_in_any_way(spark, tmp_path):
    folder = _sentences(spark, tmp_path, [(k, "d", 1, k, "results", c, "CD-1", "5 nm") for k, c in enumerate(CELLS)] + [(3, "d", 1, 3, "results", "Ex;QY", "CD-1", "5 nm")])
    pivot = Q.QUERIES["property_pivot_whole"](spark, folder).collect()
    assert [(r["pdf_name"], r["LLM_name"], r["Ex"], r["QY"], r["lifetime"], r["Em"]) for r in pivot] == [("d", "CD-1", "0;1;2;3;3", "0;1;2;3;3", "6", "")]
    assert rows(Q.QUERIES["tag_union_whole"](spark, folder)) == [("d", 1, "Ex;QY;lifetime")]
    pairs = sorted([(k, t) for k in (0, 1, 2, 3, 3) for t in ("Ex", "QY")] + [(6, "lifetime")])
    assert rows(rule_queries.QUERIES["no_digit_filter_whole"](spark, folder)) == pairs
    assert rows(rule_queries.QUERIES["tag_canonical_whole"](spark, folder).select("sent_uid", "tag")) == pairs
    assert rows(rule_queries.QUERIES["hit_assign_whole"](spark, folder).select("sent_uid", "tag")) == sorted(set(pairs))
    assert rows(rule_queries.QUERIES["route_split_whole"](spark, folder)) == [("main", "Ex", 5), ("main", "QY", 5), ("main", "lifetime", 1)]


def test_packed_tags_are_compared_with_the_main_section(spark, tmp_path):
    cells = [("results", "['Ex', 'QY']"), ("abstract", '"Ex","QY"'), ("conclusion", "Em | Ex"), (None, "CPL QY"), ("abstract", None)]
    folder = _sentences(spark, tmp_path, [(k, "d", 1, k, s, c, "CD-1", "x") for k, (s, c) in enumerate(cells)])
    got = rows(Q.QUERIES["main_dedup_whole"](spark, folder).select("section", "tag"))
    assert got == sorted([("abstract", "QY"), ("conclusion", "Em"), ("", "CPL"), ("", "QY")], key=repr)


def test_numbers_need_the_unit_of_the_tag(spark, tmp_path):
    texts = [("Em", "The emission is shown in Fig. 3."), ("['Em','QY']", "It emits at 450 nm."), ("QY", "The yield is 12.5 %."), ("lifetime", "It is 5.2 ns."), (None, "Again 450 nm in Fig. 3."), ("Chiral", "D-form"), ("Ex", None)]
    folder = _sentences(spark, tmp_path, [(k, "d", 1, k, "results", c, "CD-1", x) for k, (c, x) in enumerate(texts)])
    assert rows(rule_queries.numeric_evidence_whole(spark, folder)) == [(0, "Em", False, False), (1, "Em", True, True), (1, "QY", False, False), (2, "QY", True, False), (3, "lifetime", True, False)]
    refined = spark.createDataFrame([(1, "It emits at 460 nm.", "Em", "It emits at 450 nm."), (2, "It emits at 450 nm.", "Em", "at 450 nm"), (3, "It is chiral.", "Chiral", ""), (4, None, "Em", "450 nm")], "id int, s string, tag string, e string")
    assert rows(refined.select("id", rule_queries.numeric_valid(refined.s, refined.tag, refined.e))) == [(1, False), (2, True), (3, True), (4, False)]


def test_long_chains_end_at_their_end(spark):
    chain = spark.createDataFrame([(k, k - 1) for k in range(1, 151)] + [(1001, 1002), (1002, 1001)], "c bigint, p bigint")
    got = rows(merge_destinations(chain.coalesce(1), "c", "p"))
    assert {t for c, t in got if c <= 150} == {0} and {t for c, t in got if c > 1000} <= {1001, 1002} and len(got) == 152
