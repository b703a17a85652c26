import random

from quarrymill.llm import leakage as K
from quarrymill.llm.common import words


def test_against_brute_force(spark):
    rng = random.Random(2)
    vocabulary = [f"v{i}" for i in range(300)]
    items = [(f"i{k}", " ".join(rng.choice(vocabulary) for _ in range(rng.randint(8, 25))), " ".join(rng.choice(vocabulary) for _ in range(20)) if k % 3 else "", "x") for k in range(20)] + [("n", None, None, "x")]
    docs = []
    for d in range(60):
        w = [rng.choice(vocabulary) for _ in range(80)]
        if d % 2:
            _, q, a, _ = rng.choice(items[:20])
            said = (a if rng.random() < 0.5 and a else q).split()
            cut = said[: rng.choice([9, 10, 14])]
            w[30:30] = cut
        docs.append((d, " ".join(w).upper() if d % 5 == 0 else ", ".join(w), "x"))
    docs += [(100, None, "x"), (101, "", "x"), (102, items[0][1][:20], "x")]
    grams = {}
    for i, q, a, _ in items:
        for t in (q, a):
            w = words(t)
            for k in range(len(w) - 9):
                grams.setdefault(tuple(w[k : k + 10]), set()).add(i)
    want = {(d, i) for d, t, _ in docs for k in range(len(words(t)) - 9) for i in grams.get(tuple(words(t)[k : k + 10]), ())}
    documents = spark.createDataFrame(docs, "doc_id bigint, text string, item_id string")
    asked = spark.createDataFrame(items, "id string, query string, answer string, text string")
    got = {(r.doc_id, r.item_id) for r in K.leaked_items(documents, asked, ["query", "answer"]).collect()}
    assert got == want and len(want) > 8
    assert K.leaked_items(documents, asked.where("id = 'n'"), ["query", "answer"]).count() == 0
    assert K.leaked_items(documents.where("doc_id > 500"), asked, ["query"]).count() == 0


def test_a_passage_of_many_items_and_documents(spark):
    text = "one two three four five six seven eight nine ten"
    asked = spark.createDataFrame([(f"i{k}", f"{text} {k} eleven twelve") for k in range(12)], "id string, query string")
    got = K.leaked_items(spark.createDataFrame([(1, "so " + text + " end")], "doc_id bigint, text string"), asked, ["query"]).collect()
    assert {r.item_id for r in got} == {f"i{k}" for k in range(12)}
    many = spark.createDataFrame([(d, f"{d} {text} end") for d in range(300)], "doc_id bigint, text string")
    assert K.leaked_items(many, asked, ["query"]).count() == 300 * 12


def test_filter_drops_no_window(spark, monkeypatch):
    """A filter so small that it is full only lets more windows through to the join."""
    monkeypatch.setattr(K, "FILTER_BITS", 7)
    rng = random.Random(6)
    items = [(f"i{k}", " ".join(rng.choice("abcdefghij") * 2 for _ in range(14))) for k in range(40)]
    docs = [(k, f"start {t} end") for k, (_, t) in enumerate(items)]
    got = {(r.doc_id, r.item_id) for r in K.leaked_items(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "id string, query string"), ["query"], span=12).collect()}
    assert got == {(k, f"i{k}") for k in range(40)}


def test_edited_passages(spark):
    rng = random.Random(4)
    vocabulary = [f"v{i}" for i in range(5000)]
    items = [(f"i{k}", " ".join(rng.choice(vocabulary) for _ in range(16))) for k in range(60)]
    docs = []
    for k, (_, t) in enumerate(items):
        w = t.split()
        w[8] = "changed"
        docs.append((k, " ".join([rng.choice(vocabulary) for _ in range(30)] + w + [rng.choice(vocabulary) for _ in range(30)])))
    found = K.leaked_items(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "id string, query string"), ["query"], most_edits=1).collect()
    right = [r for r in found if r.item_id == f"i{r.doc_id}"]
    assert len(right) == len(found) >= 54 and all(r.edits == 1 for r in right)
    assert K.edit_distance([1, 2, 3, 4], [1, 3, 4, 5], 3) == 2 and K.edit_distance([1], [2, 3, 4, 5], 2) == 3


def test_recall_of_ten_words_with_two_edits(spark):
    """Against brute force: items of exactly SPAN words, two words replaced, inserted or deleted."""
    rng = random.Random(9)
    vocabulary = [f"v{i}" for i in range(20000)]
    items = [(f"i{k}", " ".join(rng.choice(vocabulary) for _ in range(10))) for k in range(600)]
    docs = []
    for k, (_, t) in enumerate(items):
        w = t.split()
        for _ in range(2):
            at = rng.randrange(len(w))
            w[at : at + rng.choice([0, 1, 1])] = rng.choice([[], [rng.choice(vocabulary)]]) if k % 2 else [rng.choice(vocabulary)]
        docs.append((k, " ".join([rng.choice(vocabulary) for _ in range(15)] + w + [rng.choice(vocabulary) for _ in range(15)])))
    want = set()
    for k, t in docs:
        w, own = words(t), words(items[k][1])
        if any(K.edit_distance(w[s : s + 10], own, 2) <= 2 for s in range(len(w) - 9)):
            want.add((k, f"i{k}"))
    found = K.leaked_items(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "id string, query string"), ["query"], most_edits=2).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert got <= want and len(want) > 400 and len(got) >= 0.9 * len(want), (len(got), len(want))
