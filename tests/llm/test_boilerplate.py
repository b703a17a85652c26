import random

from quarrymill.llm import boilerplate as B


def lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_alignment_is_longest():
    rng = random.Random(0)
    for _ in range(200):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(12))] for _ in range(2))
        i, j = B.aligned(a, b)
        assert len(i) == lcs(a, b) and [a[x] for x in i] == [b[y] for y in j]
        assert all(x < y for x, y in zip(i, i[1:])) and all(x < y for x, y in zip(j, j[1:]))


def pages(n=120, seed=1):
    rng = random.Random(seed)
    nouns = ["committee", "laboratory", "station", "archive", "library", "course", "seminar", "garden"]
    rows, truth = [], {}
    for k in range(n):
        prose = lambda: f"The {rng.choice(nouns)} number {rng.randrange(9999)} will change the {rng.choice(nouns)} and the {rng.choice(nouns)} in spring {rng.choice(nouns)} {rng.choice(nouns)}."
        head = ["Skip to main content", "Home | News | Contact"]
        body = [f"# {rng.choice(['Fees', 'Dates'])}", prose(), "- a signed plan", "- a form", prose(), rng.choice(["Fees", "Dates"]), prose()]
        foot = ["Related stories", f"The {rng.choice(nouns)} of {rng.choice(nouns)} {k}", "Copyright 2024 - Legal"]
        lines = head + body + foot
        rows.append((k, "\n".join(lines), f"https://{'a' if k % 3 else 'b'}.x.org/p/{k}"))
        truth[k] = {1, 2} | set(range(len(head) + len(body) + 1, len(lines) + 1))
    return rows, truth


def test_pages(spark):
    rows, truth = pages()
    extra = [(900, None, None), (901, "", "u"), (902, "One line", "u"), (903, "A title\n# Fees\nNo page has this sentence but this one and it is quite long.", None)]
    df = spark.createDataFrame([(k, t, u, 1) for k, t, u in rows + extra], "row_id bigint, retrieval_text string, source_url string, line_no int")
    got = {}
    for r in B.page_boilerplate(df).collect():
        got.setdefault(r.row_id, set()).add(r.line_no)
    assert got == truth
    clean = {r.row_id: r.body for r in B.page_bodies(df).collect()}
    assert len(clean) == len(rows) + 4 and clean[900] is None and clean[0].startswith("# ") and "Copyright" not in clean[0]
    assert B.page_boilerplate(df.where("row_id > 5000")).count() == 0


def test_small_host_in_a_large_corpus(spark):
    """A small host loses its own menu and notice, however many pages other hosts have."""
    rows, _ = pages(12, seed=3)
    own = []
    for k, t, _ in rows:
        lines = t.replace("Skip to main content", "Skip to our garden").replace("Home | News | Contact", "Beds | Trees | Paths").replace("Copyright 2024 - Legal", "Our garden keeps small files on your device to count how often it is read.").split("\n")
        own.append((k, "\n".join(lines), f"https://garden.org/{k}", {1, 2, len(lines) - 2, len(lines) - 1, len(lines)}))
    others = [(1000 + k, f"Note {chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676)}\nNothing here is shared by two of these pages at all, says {chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676)}.", f"https://large.org/{k}") for k in range(5000)]
    df = spark.createDataFrame([o[:3] for o in own] + others, "row_id bigint, retrieval_text string, source_url string")
    got = {}
    for r in B.page_boilerplate(df).collect():
        got.setdefault(r.row_id, set()).add(r.line_no)
    assert got == {k: lines for k, _, _, lines in own}
