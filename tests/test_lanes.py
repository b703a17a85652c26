import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarrymill.operators import chunking, dedup, graph, retrieval
from quarrymill.sources import files


def sets(spark, rows):
    return spark.createDataFrame(rows, "id bigint, shingles array<bigint>")


def test_lsh_pairs_equal_brute_force(spark):
    rng = random.Random(1)
    rows = []
    for i in range(60):
        base = rng.sample(range(100000), 40)
        rows.append((3 * i, base))
        rows.append((3 * i + 1, base[:37] + rng.sample(range(100000), 3)))
        rows.append((3 * i + 2, base[:25] + rng.sample(range(100000), 15)))
    rows.append((999, []))
    want = {(a, b) for a, x in rows for b, y in rows if a < b and x and y and len(set(x) & set(y)) >= 0.8 * len(set(x) | set(y))}
    got = {(r.a, r.b) for r in dedup.lsh_pairs(sets(spark, rows), 0.8).collect()}
    assert got == want and len(want) >= 50
    assert dedup.lsh_pairs(sets(spark, []), 0.8).count() == 0


def test_a_band_of_very_many_sets_is_cut(spark):
    rows = [(i, list(range(50)) + [1000 + i]) for i in range(90)]
    assert dedup.lsh_pairs(sets(spark, rows), 0.8, spread=20).count() == 90 * 89 // 2


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)], "a bigint, b bigint")
    got = dedup.components(links.select(F.col("a").alias("id")), links)
    assert got.count() == 301 and got.select("component").distinct().collect()[0][0] == 0


def test_communities_of_a_bipartite_graph_settle(spark):
    edges = spark.createDataFrame([(a, b) for a in (1, 2, 3) for b in (11, 12, 13)] + [(21, 22)], "source_id bigint, target_id bigint")
    nodes = spark.createDataFrame([(i,) for i in (1, 2, 3, 11, 12, 13, 21, 22, 31)], "id bigint")
    got = {r.id: r.community for r in graph.label_communities(nodes, edges).collect()}
    assert len({got[i] for i in (1, 2, 3, 11, 12, 13)}) == 1 and got[21] == got[22] != got[1] and got[31] is None


def test_bm25_against_a_plain_loop(spark):
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choice("ab cd ef gh ij kl mn".split()) for _ in range(rng.randint(0, 9)))) for i in range(80)] + [(90, None)]
    queries = [("q1", "ab zz AB"), ("q2", ""), ("q3", "kl, mn!"), ("q4", None)]
    tokens = {i: (t or "").split() for i, t in docs}
    mean = sum(map(len, tokens.values())) / len(tokens)
    want = {}
    for q, text in queries:
        scores = []
        for i, w in tokens.items():
            s = 0.0
            for t in (text or "").lower().replace(",", "").replace("!", "").split():
                df = sum(t in x for x in tokens.values())
                tf = w.count(t)
                s += np.log(1 + (len(tokens) - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len(w) / mean))
            if round(s, 6) > 0:
                scores.append((-round(s, 6), i))
        want[q] = [(i, -s) for s, i in sorted(scores)[:5]]
    got = {}
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    for r in retrieval.bm25(df, spark.createDataFrame(queries, "query_id string, text string"), 5).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.doc_id, pytest.approx(r.score, abs=2e-6)))
    assert got == {q: w for q, w in want.items() if w}
    assert retrieval.bm25(df.where("doc_id < 0"), spark.createDataFrame(queries, "query_id string, text string")).count() == 0


def test_sentence_windows_against_a_plain_loop(spark):
    rng = random.Random(2)
    texts = [" ".join("w" * rng.choice([3, 20, 90]) + "." for _ in range(n)) for n in (0, 1, 3, 9, 30)] + ["x" * 2000 + ". short one."]
    want = {}
    for k, t in enumerate(texts):
        ss, spans, i = [s for s in t.split(" ") if s] if k < 5 else ["x" * 2000 + ".", "short one."], [], 0
        while i < len(ss):
            window = []
            while i < len(ss) and len(window) < 4:
                joined = " ".join([*window, ss[i]])
                if window and len(joined) > 300:
                    break
                window.append(ss[i])
                i += 1
                if len(joined) >= 0.65 * 300:
                    break
            spans.append(" ".join(window)[:300])
        if spans:
            want[k] = spans
    df = spark.createDataFrame([*enumerate(texts), (50, None)], "id bigint, t string")
    got = {}
    for r in chunking.sentence_windows(df, "id", "t", 4, 300).orderBy("id", "span_no").collect():
        got.setdefault(r.id, []).append(r.span)
    assert got == want


def test_limits_and_conflicts_fail_loudly(spark):
    df = spark.createDataFrame([(1, "abc", "x"), (1, "abc", "x"), (2, "abcdef", "y")], "id bigint, text string, other string")
    assert chunking.enforce_chunk_limit(df, "text", 6).count() == 3 and dedup.unique_by_id(df, "id", "text").count() == 2
    with pytest.raises(Exception, match="chunk of 6"):
        chunking.enforce_chunk_limit(df, "text", 5).collect()
    with pytest.raises(Exception, match="conflicting contents of id 1"):
        dedup.unique_by_id(df.union(spark.createDataFrame([(1, "other", "x")], df.schema)), "id", "text").collect()


def test_bootstrap_against_numpy(spark):
    values = [float(x) for x in np.random.default_rng(1).normal(0.2, 1, 60)]
    r = retrieval.paired_bootstrap(spark.createDataFrame([(v,) for v in values] + [(None,)], "d double"), "d", 200).first()
    v = np.sort(values)
    means = np.array([v[np.random.default_rng([7, n]).integers(0, 60, 60)].mean() for n in range(200)])
    assert r.mean_delta == pytest.approx(means.mean()) and r.ci95_low == pytest.approx(np.percentile(means, 2.5)) and r.ci95_high == pytest.approx(np.percentile(means, 97.5))
    assert tuple(retrieval.paired_bootstrap(spark.createDataFrame([], "d double"), "d", 20).first()) == (0.0, 0.0, 0.0)


def test_sink_replaces_and_default_reads(spark, tmp_path):
    path = f"{tmp_path}/out"
    schema = "a bigint, b string"
    assert [tuple(r) for r in files.read_json_or(spark, path, schema, [(7, "d")]).collect()] == [(7, "d")]
    for n in (1, 2):
        files.write_json_lines(spark.createDataFrame([(n, "x")], schema), path)
    assert [tuple(r) for r in files.read_json_or(spark, path, schema, []).collect()] == [(2, "x")] and not (tmp_path / "out.old").exists()
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part.json").write_text("{no json\n")
    assert [tuple(r) for r in files.read_json_or(spark, f"{tmp_path}/bad", schema, [(7, "d")]).collect()] == [(7, "d")]
