import random

import numpy as np

from quarrymill.llm import near_edit
from quarrymill.llm.common import compare_buckets, words

WORDS = [f"w{i}" for i in range(400)]


def corpus(seed=1, n=40):
    rng = random.Random(seed)
    rows, texts = [], []
    for _ in range(n):
        base = [rng.choice(WORDS) for _ in range(rng.randint(40, 120))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 3)):
            w = list(base)
            for _ in range(rng.randint(1, 3)):
                w[rng.randrange(len(w))] = rng.choice(WORDS)
            texts.append(" ".join(w))
    for i, t in enumerate(texts):
        rows.append((i, t))
        if i % 7 == 0:
            rows.append((1000 + i, t))
    return rows


def truth(rows, threshold, least=30):
    sets = {k: {tuple(words(t)[i : i + 5]) for i in range(len(words(t)) - 4)} for k, t in rows if t and len(words(t)) >= least}
    text = dict(rows)
    keys = sorted(sets)
    return {(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if text[a] != text[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])}


def test_pairs_against_brute_force(spark):
    rows = corpus()
    odd = [(5000, None), (5001, ""), (5002, "too short"), (5003, "?!")]
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in rows + odd], "row_id bigint, retrieval_text string, a string, id int")
    got = {tuple(r) for r in near_edit.near_edit_pairs(df).collect()}
    want = truth(rows, 0.7)
    assert got <= want and len(got) >= 0.97 * len(want) and len(want) > 50


def test_empty_table(spark):
    assert near_edit.near_edit_pairs(spark.createDataFrame([], "row_id bigint, retrieval_text string")).count() == 0


def test_links_name_each_text_once(spark):
    df = spark.createDataFrame(corpus(), "row_id bigint, retrieval_text string")
    links, members = near_edit.near_edit_links(df, threshold=0.8)
    rep = {r.row_key: r.a for r in members.collect()}
    assert all(rep[r.a] == r.a and rep[r.b] == r.b and r.similarity >= 0.8 for r in links.collect()) and rep[1000] == 0


def test_anchors_cover(spark=None):
    """Two fingerprints that differ in at most SYMBOLS - DIMENSION symbols share an anchor; a far one shares none."""
    rng = np.random.default_rng(2)
    a = rng.integers(0, near_edit.P, (1, near_edit.SYMBOLS))
    for wrong in range(near_edit.SYMBOLS + 1):
        b = a.copy()
        b[0, :wrong] = rng.integers(0, near_edit.P, wrong)
        shared = set(near_edit.anchors(a)[0]) & set(near_edit.anchors(b)[0])
        assert bool(shared) == (wrong <= near_edit.SYMBOLS - near_edit.DIMENSION)


def test_hot_buckets_lose_no_pair(spark):
    rows = [(1, i, i % 5) for i in range(150)] + [(2, 7, 0), (2, 8, 0), (3, 9, 0)]
    df = spark.createDataFrame(rows, "bucket bigint, id bigint, x bigint")
    near = lambda a, b: a[0] == b[0]
    want = {(a, b) for a in range(150) for b in range(a + 1, 150) if a % 5 == b % 5} | {(7, 8)}
    plain = {tuple(r) for r in compare_buckets(df, near, 3, block=32).collect()}
    cut = {tuple(r) for r in compare_buckets(df, near, 3, spark.createDataFrame([(1, 4)], "bucket bigint, blocks int"), block=16).collect()}
    assert plain == want and cut == want


def test_groups(spark):
    rows = corpus()
    df = spark.createDataFrame(rows + [(5000, None), (5001, "")], "row_id bigint, retrieval_text string")
    got = {r.row_id: r for r in near_edit.near_edit_groups(df, threshold=0.7, least_words=30).collect()}
    pairs = truth(rows, 0.7)
    text = dict(rows)
    reps = {i: min(j for j, t in rows if t == text[i]) for i, _ in rows}
    assert set(got) == set(text) and all(got[i].copies == sum(t == text[i] for _, t in rows) for i in text)
    links = {(min(reps[a], reps[b]), max(reps[a], reps[b])) for a, b in pairs}
    missed = sum(got[a].class_id != got[b].class_id for a, b in links)
    assert missed <= 0.03 * len(links) and all(got[i].class_id == got[reps[i]].class_id for i in got)
    assert sum(got[i].links for i in got if i == reps[i]) <= 2 * len(links)
    assert near_edit.near_edit_groups(spark.createDataFrame([], "row_id bigint, retrieval_text string")).count() == 0


def test_many_near_copies_of_one_text(spark):
    """600 different near copies: every pair is found, though each text is sent only to a few tasks."""
    rng = random.Random(5)
    base = [rng.choice(WORDS) for _ in range(90)]
    rows = []
    for i in range(600):
        w = list(base)
        w[-1] = f"x{i}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "row_id bigint, retrieval_text string")
    assert near_edit.near_edit_pairs(df).count() == 600 * 599 // 2
