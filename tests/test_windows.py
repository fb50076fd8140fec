import pytest

from dotledger.plans import evidence_queries as Q

COLUMNS = "sent_uid bigint, pdf_name string, para_global_id int, sent_global_id int, main_section_norm string, cand_props string, window_level string, text string"


def _windows(spark, folder, query, sentences):
    """sentences: (paragraph, whether a candidate) in order; the window of each candidate by its number."""
    data = [(k, "d", para, k, "results", "Ex" if cand else "", "SMALL" if cand else None, f" s{k}") for k, (para, cand) in enumerate(sentences)]
    spark.createDataFrame([*data, (99, None, 1, 0, "results", "Ex", "SMALL", "x")], COLUMNS).coalesce(1).write.mode("overwrite").parquet(f"{folder}/decisions.parquet")
    return {r["sent_uid"]: " ".join(r["window_text"].split()) for r in query(spark, str(folder)).collect()}


@pytest.mark.parametrize("sentences, small, refined", [
    ([(1, 0), (1, 1), (1, 1), (1, 0)], {1: "s0 s1 s2", 2: "s0 s1 s2"}, {1: "s0 s1 s2 s3", 2: "s0 s1 s2 s3"}),  # padded on the left first
    ([(0, 0), (1, 1), (1, 1), (1, 0), (1, 0), (1, 0)], {1: "s1 s2 s3", 2: "s1 s2 s3"}, {1: "s1 s2 s3 s4 s5", 2: "s1 s2 s3 s4 s5"}),  # within the paragraph
    ([(1, 0), (1, 0), (1, 0), (1, 1), (1, 1), (1, 0)], {3: "s2 s3 s4", 4: "s2 s3 s4"}, {3: "s1 s2 s3 s4 s5", 4: "s1 s2 s3 s4 s5"}),  # left and right in turn
    ([(0, 0), (1, 1), (2, 0)], {1: "s1 s0 s2"}, {1: "s0 s1 s2"}),  # alone, across paragraphs
    ([(1, 1), (1, 0), (1, 0), (1, 1), (1, 0)], {0: "s0 s1 s2 s3", 3: "s0 s1 s2 s3"}, {0: "s0 s1", 3: "s2 s3 s4"}),  # one island by places, two by ids
])
def test_windows_of_islands(spark, tmp_path, sentences, small, refined):
    assert _windows(spark, tmp_path, Q.small_windows, sentences) == small
    assert _windows(spark, tmp_path, Q.refine_windows, sentences) == refined


def test_every_small_row_has_a_window(spark, data):
    want = spark.read.parquet(f"{data}/decisions.parquet").filter("pdf_name is not null and window_level = 'SMALL'").count()
    assert Q.small_windows(spark, data).count() == want == Q.refine_windows(spark, data).count()
