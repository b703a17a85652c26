import random

from pyspark.sql import functions as F

from quarrymill.operators import assertions, chunking, dedup, graph, html, retrieval


def brute_pairs(texts, threshold, size=5):
    import re

    sets = {}
    for k, t in texts.items():
        w = re.findall(r"[^\W_]+", t.lower())
        if w:
            sets[k] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or {tuple(w)}
    keys = sorted(sets)
    return {(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= threshold}


def test_similar_sets_is_exact(spark):
    rng = random.Random(3)
    base = [" ".join(rng.choice("alpha beta gamma delta eta theta iota kappa".split()) for _ in range(40)) for _ in range(12)]
    texts = {}
    for i in range(60):
        w = rng.choice(base).split()
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = rng.choice(["omega", "psi"])
        texts[i] = " ".join(w)
    texts[60], texts[61] = "short text", ""
    rows = [(k, t, "x") for k, t in texts.items()] + [(99, None, "x")]
    pairs, members = dedup.near_duplicates(spark.createDataFrame(rows, "doc bigint, body string, id string"), "doc", "body", 0.6)
    rep = {r.id: r.representative for r in members.collect()}
    assert 99 not in rep and set(rep) == set(texts)
    assert all(texts[k] == texts[v] and v <= k for k, v in rep.items())
    firsts = {k: t for k, t in texts.items() if rep[k] == k}
    assert {(r.a, r.b) for r in pairs.collect()} == brute_pairs(firsts, 0.6)


def test_near_duplicates_of_nothing(spark):
    pairs, members = dedup.near_duplicates(spark.createDataFrame([], "doc bigint, body string"), "doc", "body")
    assert pairs.count() == 0 and members.count() == 0


def test_components(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(30)] + [(100 + rng.randrange(20), 100 + rng.randrange(20)) for _ in range(15)] + [(7, 7)] + [(500, 500 + i) for i in range(1, 60)]
    nodes = spark.createDataFrame([(i,) for i in [*range(31), *range(100, 120), 900]], "id bigint")
    found = {r.id: r.component for r in dedup.components(nodes, spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = top(a), top(b)
        parent[max(x, y)] = min(x, y)
    for n in [*range(31), *range(100, 120), 900]:
        top(n)
    assert found == {n: top(n) for n in parent}


def test_hamming_pairs(spark):
    rng = random.Random(1)
    values = [rng.getrandbits(64) for _ in range(30)]
    values += [v ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for v in values[:10]] + [values[0]]
    rows = [(i, f"{v:016x}") for i, v in enumerate(values)] + [(77, None), (78, "xyz")]
    got = {(r.a, r.b, r.distance) for r in dedup.hamming_pairs(spark.createDataFrame(rows, "id bigint, h string"), "id", "h", 2).collect()}
    distinct = sorted({f"{v:016x}" for v in values})
    want = {(a, b, bin(int(a, 16) ^ int(b, 16)).count("1")) for i, a in enumerate(distinct) for b in distinct[i + 1 :]}
    assert got == {x for x in want if x[2] <= 2} and len(got) >= 8


def test_survivors(spark):
    df = spark.createDataFrame([("k", 2, 1), ("k", 2, 0), (None, 1, 5), (None, 1, 6)], "key string, score int, _x int")
    got = {(r.key, r._x) for r in dedup.survivors(df, ["key"], F.desc("score"), F.col("_x")).collect()}
    assert got == {("k", 0), (None, 5)}


def test_greedy_survivors(spark):
    rng = random.Random(9)
    for n in (1, 25):
        pairs = {tuple(sorted(rng.sample(range(n), 2))) for _ in range(40)} if n > 1 else set()
        ranks = list(range(n))
        rng.shuffle(ranks)
        near = {i: {b if a == i else a for a, b in pairs if i in (a, b)} for i in range(n)}
        want, kept = {}, set()
        for i in sorted(range(n), key=lambda i: ranks[i]):
            better = [j for j in near[i] if j in kept]
            want[i] = min(better, key=lambda j: ranks[j]) if better else None
            if not better:
                kept.add(i)
        got = assertions.greedy_survivors(spark.createDataFrame([(i, ranks[i]) for i in range(n)], "id bigint, rank int"), spark.createDataFrame(sorted(pairs), "a bigint, b bigint"))
        assert {r.id: r.winner for r in got.collect()} == want


def test_chunks(spark):
    text = "# A\n\n" + " ".join(f"word{i}." for i in range(900)) + "\n\n## B\n\n- one\n- two\n\n```\n# no heading\n```"
    rows = chunking.markdown_chunks(spark.createDataFrame([(1, text), (2, None), (3, " ")], "id bigint, t string"), "id", "t").collect()
    assert {r.id for r in rows} == {1}
    assert all(r.tokens <= 650 for r in rows) and [r.chunk_index for r in rows] == list(range(len(rows)))
    assert rows[-1].section == "A > B" and "# no heading" in rows[-1].chunk
    said = " ".join(r.chunk for r in rows)
    assert all(f"word{i}." in said for i in range(900))


def test_word_windows(spark):
    df = spark.createDataFrame([(1, " ".join(map(str, range(1000)))), (2, "a b"), (3, None), (4, "...")], "id int, t string")
    rows = chunking.word_windows(df, "id", "t", 450, 80).orderBy("id", "chunk_index").collect()
    assert [(r.id, r.first_word, r.chunk_words) for r in rows] == [(1, 0, 450), (1, 370, 450), (1, 740, 260), (2, 0, 2)]


def test_rank_fusion_and_metrics(spark):
    lane = lambda ids: spark.createDataFrame([("q", d, i + 1) for i, d in enumerate(ids)], "query_id string, doc_id bigint, rank int")
    fused = retrieval.top_k(retrieval.fuse([lane([1, 2]), lane([2, 1])]), "query_id", "doc_id", "score", 5).collect()
    assert [(r.doc_id, r.rank) for r in fused] == [(1, 1), (2, 2)] and fused[0].score == fused[1].score == round(1 / 61 + 1 / 62, 9)
    gold = spark.createDataFrame([("q", 2), ("q", 9), ("none", 1)], "query_id string, doc_id bigint")
    got = {r.query_id: r for r in retrieval.ranking_metrics(lane([1, 2]), gold, 10).collect()}
    assert (got["q"].hit, got["q"].recall, got["q"].mrr) == (1.0, 0.5, 0.5) and got["none"].ndcg == 0.0


def test_dense_blocks(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    v = rng.standard_normal((60, 8))
    v[10] = 0
    items = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "id bigint, vector array<double>")
    got = retrieval.dense_top_k(items, items.where("id < 7"), 3, block=2).collect()
    n = v / np.where(np.linalg.norm(v, axis=1, keepdims=True) > 0, np.linalg.norm(v, axis=1, keepdims=True), 1)
    for q in range(7):
        c = np.round(n @ n[q], 9)
        want = sorted((i for i in range(60) if i != q), key=lambda i: (-c[i], i))[:3]
        assert [r.item_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] == want


def test_graph(spark):
    nodes = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("a",), (None,)], "id string")
    edges = spark.createDataFrame([("a", "b", "t"), ("b", "c", "t"), ("c", "a", "u"), ("c", "z", "t")], "source_id string, target_id string, edge_type string")
    assert {(r.issue, r.id) for r in graph.issues(nodes, edges).collect()} == {("repeated_node", "a"), ("node_without_id", ""), ("dangling_edge", "z")}
    got = {(r.id, r.depth) for r in graph.reachable(edges, spark.createDataFrame([("a",)], "id string"), 2, ["t"]).collect()}
    assert got == {("a", 0), ("b", 1), ("c", 2)}
    links = [(0, 1), (1, 2), (0, 2), (3, 4), (4, 5), (3, 5), (2, 3), (6, 7)]
    e = spark.createDataFrame([(f"n{a}", f"n{b}", "x") for a, b in links], "source_id string, target_id string, edge_type string")
    n = spark.createDataFrame([(f"n{i}",) for i in range(9)], "id string")
    first, again = ({r.id: r.community for r in graph.label_communities(n, e).collect()} for _ in range(2))
    assert first == again and first["n8"] is None and first["n6"] == first["n7"] and first["n0"] == first["n1"]


def test_assertions(spark):
    rows = [("S", "p", "t", "x", 0.9, 0.8, 1.0, ["c1"], "supported"), ("S", "p", "t", "x", 0.7, 0.9, 0.5, ["c2", "c1"], "supported"), ("S", "p", "t", "y", 0.5, 0.4, 0.5, [], "ambiguous"), ("T", "p", None, "z", 0.9, 0.9, 0.9, ["c3"], None)]
    df = spark.createDataFrame(rows, "subject_name string, predicate string, answer_subtype string, object_value string, confidence double, authority_score double, freshness_score double, source_chunk_ids array<string>, validator_decision string")
    m = assertions.merged(df)
    got = {r.object_value: r for r in assertions.governed(m).collect()}
    assert got["x"].source_chunk_ids == ["c1", "c2"] and got["x"].confidence == 0.9 and got["x"].merged == 2
    assert (got["x"].validity, got["y"].validity, got["z"].validity) == ("active", "superseded", "active")
    assert [r.promotion for r in assertions.promoted(df).orderBy("object_value", "confidence").collect()] == ["promoted", "promoted", "quarantined", "quarantined"]


def test_media_pages_decide_alone(spark):
    media = spark.createDataFrame([("m1", "d", 13, ["A"], "none here at all, really"), ("m2", "d", None, ["A"], None)], "media_id string, document_id string, page_number int, section_path array<string>, context string")
    near = spark.createDataFrame([("c1", "d", [13, 14], ["A", "B"], "B", "text"), ("c2", "d", [103, 104], ["A"], "A", "text")], "chunk_id string, document_id string, page_numbers array<int>, section_path array<string>, heading string, text string")
    got = {r.media_id: (r.chunk_id, r.score, r.reason) for r in assertions.media_matches(media, near).collect()}
    assert got == {"m1": ("c1", 100, "exact_page"), "m2": ("c2", 95, "exact_section")}
    assert assertions.media_matches(media.where("media_id = 'm1'"), near.where("chunk_id = 'c2'")).count() == 0


def test_html(spark):
    page = """<html lang="en"><head><title> A &amp; B </title><meta name="robots" content="NOINDEX, follow"><link rel="canonical" href="/x"></head><body><nav><a href="/home">Home</a></nav>
    <main><h1>Hello</h1><p>One <b>two<p>Three<script>var a;</script><a href="f.pdf">file</a> <a href="https://other.org/#t">out</a></main><div class="cookie-banner">We use</div><footer>Foot</footer></body></html>"""
    pages = spark.createDataFrame([("https://x.org/a/", page), ("u", None)], "url string, html string")
    got = {r.url: r for r in html.page_records(pages).collect()}["https://x.org/a/"]
    assert (got.title, got.canonical, got.noindex, got.language, got.n_links) == ("A & B", "https://x.org/x", True, "en", 3)
    assert got.markdown == "# Hello\n\nOne two\n\nThreefile out" and "Foot" in got.visible_text and "var a" not in got.visible_text
    edges = {(r.target_url, r.link_type) for r in html.link_edges(pages).collect()}
    assert edges == {("https://x.org/home", "internal"), ("https://x.org/a/f.pdf", "document"), ("https://other.org/", "external")}
