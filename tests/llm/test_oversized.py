from hypothesis import given, settings, strategies as st

from dotledger.llm.oversized import boundary_strengths, split_oversized, split_text, tokens
from tests.conftest import rows

PIECE = st.sampled_from(["word ", "one. Two ", "a, b ", "\n\n", "漢字。", "漢", "e.g. x ", "(y) ", "5.2 "])


@settings(max_examples=200, deadline=None)
@given(st.lists(PIECE, max_size=120).map("".join), st.sampled_from([(10, 0), (10, 3), (25, 24), (40, 10)]))
def test_pieces_cover_the_text(text, sizes):
    limit, overlap = sizes
    spans = tokens(text)
    pieces = split_text(text, limit, overlap)
    assert (len(pieces) > 1) == (len(spans) > limit)
    seen = 0
    for k, (first, count, shared, piece) in enumerate(pieces):
        assert count <= limit or len(pieces) == 1
        assert shared == (overlap if k else 0) and first + shared == seen
        assert tokens(piece) == [(a - spans[first][0], b - spans[first][0]) for a, b in spans[first : first + count]] if spans else piece == ""
        seen = first + count
    assert seen == len(spans)


def test_prefers_strong_boundaries():
    text = " ".join(["This is a sentence of seven words."] * 40)
    pieces = split_text(text, 100, 10)
    strengths = boundary_strengths(text, tokens(text))
    assert all(strengths[first + shared] >= 4 for first, _, shared, _ in pieces[1:])
    assert max(c for _, c, _, _ in pieces) - min(c for _, c, _, _ in pieces) < 40


def test_operator_edges(spark):
    long = "word " * 160
    df = spark.createDataFrame([(1, long, 5, 0), (2, None, 900, 1), (3, "", None, 2), (4, "short", 400, 3), (1, long, 5, 0)], "chunk_uid bigint, text string, token_count int, piece_no int")
    got = rows(split_oversized(df, "chunk_uid", "text").select("chunk_uid", "piece_no", "token_count", "shared_tokens"))
    assert len(got) == 4 and {g[0] for g in got} == {1} and all(g[2] <= 150 for g in got) and {g[3] for g in got} == {0, 15}
    assert split_oversized(df.limit(0), "chunk_uid", "text").count() == 0
