import random

from hypothesis import given, settings
from hypothesis import strategies as st

from quarrymill.llm import split
from quarrymill.llm.common import words


def check(text, limit, overlap):
    out = split.pieces(text, limit, overlap)
    n = len(words(text))
    assert out[0][0] == 0 and out[-1][1] == n
    for (a, b, s), (c, _, _) in zip(out, out[1:]):
        assert c == b - overlap and c > a
    for a, b, s in out:
        assert b - a <= limit or n <= limit
        assert words(s) == words(text)[a:b]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab1é. \n!?-İß", max_size=400), st.integers(2, 9))
def test_round_trip(text, limit):
    check(text, limit, limit // 3)


def test_cuts_at_the_last_boundary():
    text = " ".join(f"w{i}" + ("." if i in (5, 8) else "") for i in range(20))
    out = split.pieces(text, 10, 2)
    assert [x[:2] for x in out] == [(0, 9), (7, 17), (15, 20)]  # after the full stop, then hard
    assert out[0][2].endswith("w8.")


def test_tables(spark):
    rng = random.Random(0)
    long = " ".join(rng.choice(["one", "two.", "three\n"]) for _ in range(2000))
    df = spark.createDataFrame([(1, long, 5), (2, "short", 5), (3, None, 5), (4, "", 5)], "row_id bigint, retrieval_text string, piece_no int")
    every = split.split_oversized(df).collect()
    assert {r.row_id for r in every if r.piece_count == 1} == {2, 3, 4}
    mine = sorted((r for r in split.oversized(df).collect()), key=lambda r: r.piece_no)
    assert {r.row_id for r in mine} == {1} and [r.piece_no for r in mine] == list(range(1, len(mine) + 1))
    assert split.oversized(df.where("row_id > 9")).count() == 0
    check(long, 650, 80)
