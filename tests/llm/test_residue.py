from quarrymill.llm import residue as R

RESIDUE = ["{{image_caption}}", "${media.alt}", "[Insert caption here]", "404 Not Found", "HTTP ERROR 403", "Please enable JavaScript to view this content.", "Lorem ipsum dolor sit amet.", "test test 123", "xxxxxxxx", "TODO: write description", "Erreur 404 : page introuvable", "The west campus {number} the open day.", "Checking your browser before access…", "<caption goes here>", "نص تجريبي نص تجريبي", "%TITLE%", "__DESC__"]
REAL = ["Room 404 beside the canteen.", "A JavaScript workshop for students.", "Diagram with the variables {a, b, c} and arrows.", "The tagger marks the [NP] span.", "for (i = 0; i < 10; i++) { sum += i; }", "Poster about error pages.", "A foundation stone, a placeholder for the later plaque.", "Chart of a 73 percent change.", "Volunteers search for a page not found in the codex.", "Slide showing {x | x > 0} on a board."]


def test_patterns():
    assert [s for s in RESIDUE if not R.trusted(s)] == []
    assert [s for s in REAL if R.trusted(s)] == []


def test_labels_spread_to_near_messages_only(spark):
    values = ["Your session has expired, please sign in again.", "Yuor session has expired, please sign in again", "The session of the committee has started with a song.", "The west campus {number} the open day.", "The west campus during the open day."]
    rows = [(f"m{i}", "image", v, None, "x") for i, v in enumerate(values)] + [("m9", "image", None, "", "x"), ("m0", "image", values[0], None, "x")]
    df = spark.createDataFrame(rows, "id string, media_type string, caption string, description string, field string")
    got = {(r.media_id, r.field) for r in R.residue_values(df).collect()}
    assert got == {("m0", "caption"), ("m1", "caption"), ("m3", "caption")}
    clean = {r.id: r.caption for r in R.indexable(df).collect()}
    assert clean["m0"] is None and clean["m4"] == values[4] and R.indexable(df).count() == len(rows)


def test_parts_of_a_value(spark):
    df = spark.createDataFrame([("a", "A real photo of the hall. 503 Service Unavailable – please try again later", "A real photo of the hall.")], "id string, caption string, description string")
    assert {(r.media_id, r.field) for r in R.residue_values(df).collect()} == {("a", "caption")}
    assert R.residue_values(df.where("id = 'none'")).count() == 0


def test_spread_against_brute_force(spark):
    """Half of the labelled forms are withheld: what brute force reaches from the other half is nearly all reached by the tables."""
    import hashlib
    import os

    import pytest

    root = "/root/testdata/sf0.1"
    if not os.path.exists(root):
        pytest.skip("no test tables")
    media = spark.read.parquet(f"{root}/media.parquet")
    values = media.selectExpr("caption as value").union(media.selectExpr("description as value")).where("trim(value) != ''").distinct()
    sentences = {s for r in values.collect() for s in R.sentence_list(r.value)}
    forms = {R.sentence_form(s) for s in sentences} - {""}
    messages = {R.sentence_form(s) for s in sentences if R.trusted(s) == "message"} - {""}
    variables = {R.sentence_form(s) for s in sentences if R.trusted(s) == "variable"} - messages
    seeds = {f for f in messages if hashlib.md5(f.encode()).digest()[0] % 2}

    def half(s):
        return R.trusted(s) if R.trusted(s) != "message" or R.sentence_form(s) in seeds else None

    def near(a, b):
        most = int((1 - R.LEAST_SIMILARITY) * max(len(a), len(b)) + 1e-9)
        if abs(len(a) - len(b)) > most:
            return False
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
        return row[-1] <= most

    reached, front = set(seeds), set(seeds)
    while front:
        front = {f for f in forms - reached - variables if any(near(f, g) for g in front)}
        reached |= front
    got = {r.form for r in R.residue_forms(values, half).collect()} - variables
    share = len((got - seeds) & (reached - seeds)) / len(reached - seeds)
    print(f"withheld {len(messages - seeds)}, brute force reaches {len(reached & messages - seeds)}, tables {len(got & messages - seeds)}; share of all reached {share:.3f}; outside {len(got - messages)}")
    assert got <= reached and share >= 0.9
