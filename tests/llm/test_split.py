from hypothesis import example, given, settings
from hypothesis import strategies as st

from leafwork.llm import split


TEXTS = st.text(alphabet="ab .,;\n\n。漢é́”", max_size=400)


@settings(max_examples=400, deadline=None)
@given(TEXTS, st.integers(1, 60), st.integers(0, 80))
@example(";a\u0301; aa; ", 7, 3)
@example(";á; aa; ", 7, 3)
def test_spans_cover_within_limits(text, limit, overlap):
    spans = split.split_spans(text, limit, overlap)
    assert spans[0][0] == 0 and spans[-1][1] == len(text)
    assert all(b - a <= limit for a, b, _ in spans)
    for (a, b, _), (c, d, _) in zip(spans, spans[1:]):
        assert a < c <= b < d
        if overlap == 0:
            assert c == b


@settings(max_examples=400, deadline=None)
@given(TEXTS, st.integers(1, 30), st.integers(0, 40))
@example("a" * 10 + "." + "b" * 10, 10, 4)
@example("aa " + " " * 50 + "bb", 5, 2)
def test_hard_cuts_only_in_runs_above_the_limit(text, limit, overlap):
    spans = split.split_spans(text, limit, overlap)
    longest = max(map(len, split.regex.split(r"[\s.;:,!?|。；：，！？、]", text)))
    assert split.cut_kind(text, spans, limit) == ("hard" if longest > limit else "soft")
    if longest <= limit:
        assert all(level > 0 for _, _, level in spans[:-1])


def test_prefers_strong_boundaries():
    text = "One sentence here. " * 10 + "\n\n" + "Another sentence there. " * 8
    spans = split.split_spans(text, 220, 0)
    assert len(spans) == 2 and spans[0][2] == 5 and text[: spans[0][1]].endswith("\n\n")
    assert [s[2] for s in split.split_spans("x" * 25, 10, 0)] == [0, 0, 0]


def test_minimum_number_and_overlap():
    text = "word " * 500
    spans = split.split_spans(text, 1000, 100)
    assert len(spans) == 3
    assert all(60 <= a[1] - b[0] <= 150 for a, b in zip(spans, spans[1:]))


def test_short_empty_and_long():
    assert split.split_spans("", 5) == [(0, 0, 0)] and split.split_spans("abc", 5, 2) == [(0, 3, 0)]
    long = "lorem ipsum, dolor. " * 50_000
    assert all(b - a <= 1200 for a, b, _ in split.split_spans(long, 1200, 120))


def test_over_spark(spark):
    limits = spark.createDataFrame([("paragraph", "character", 10, 2), ("documents", "token", 5, 0)], "scope string, unit string, max_size int, overlap int")
    data = [(1, "d", 0, "paragraph", "aa bb cc dd ee", 9), (2, "d", 0, "paragraph", "x" * 30, 9), (3, "d", 0, "list", "y" * 99, 9), (4, None, None, "paragraph", None, 9),
            (5, "d", 0, None, "z" * 99, 9), (6, "d", 0, "paragraph", "", 9), (1, "d", 0, "paragraph", "aa bb cc dd ee", 9)]
    blocks = spark.createDataFrame(data, "block_id long, doc_id string, page_num int, block_type string, text string, piece int")
    pieces = split.split_oversized(blocks, limits)
    rows = pieces.collect()
    assert {(r.block_id, r.cut) for r in rows} == {(1, "soft"), (2, "hard")}
    assert all(len(r.piece) <= 10 and r.block_type == "paragraph" for r in rows)
    assert split.found_oversized(pieces).count() == 3
    assert split.split_oversized(blocks.where("false"), limits).count() == 0
    assert split.split_oversized(blocks, limits.where("false")).count() == 0
