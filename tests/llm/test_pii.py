import numpy as np
import pytest

from quarrymill.llm import pii as P

CASES = [
    ("Contact: Jonas Fynsen, marta-x@labs.example.org", {("name", "Jonas Fynsen"), ("email", "marta-x@labs.example.org")}),
    ("For questions write to nils_r [at] post [dot] harsby [dot] example or call +44 1632 960651.", {("email", "nils_r [at] post [dot] harsby [dot] example"), ("phone", "+44 1632 960651")}),
    ("Visa file: Wessula, Karim; Emirates ID 9557 7793 9742; +999 (0)4 555-99-02.", {("name", "Wessula, Karim"), ("id_number", "9557 7793 9742"), ("phone", "+999 (0)4 555-99-02")}),
    ("The form was signed by Nadia E. Zabik, who lives at Flat 25, 28 Heron Row, Harsby HB5 1QZ.", {("name", "Nadia E. Zabik"), ("address", "Flat 25, 28 Heron Row, Harsby HB5 1QZ")}),
    ("Ansprechpartner: SALMA TREMIM, Tel. 01632 960 229 ext. 35", {("name", "SALMA TREMIM"), ("phone", "01632 960 229 ext. 35")}),
    ("Supervisor: Dr. Omar-Luis Fynrane The Chair of Causal Statistics", {("name", "Omar-Luis Fynrane")}),
    ("قدم الطالب كريم بن فلور رقم الهوية 20238689 للمراجعة.", {("name", "كريم بن فلور"), ("id_number", "20238689")}),
    ("The grant NV-2291-0045 ends when report 27-B is filed. Dataset DOI 10.99999/nv.2291.0045 holds 12,450 rows.", set()),
    ("See volume 12, pages 211–0459, shelf mark 978-0-5551-2291-4. Sensor 0x7F3A-1190 logged 1 204 556 readings.", set()),
    ("Follow the account @norvale_labs. Course ROB 555-0199 is cross-listed in the Institute of Marine Sensing.", set()),
]


@pytest.fixture(scope="module")
def model():
    return P.Model([t for t, _ in CASES] * 5)


def test_spans(model):
    for text, want in CASES:
        assert {(k, text[a:b]) for a, b, k, _ in model.spans(text)} == want, text


def test_placeholders_keep_the_rest(model):
    text = CASES[0][0]
    assert P.masked(text, model.spans(text)) == "Contact: [NAME], [EMAIL]"
    assert model.spans(None) == [] and model.spans("") == []


def test_reliabilities_find_the_bad_labeler():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.4
    votes = np.stack([np.where(rng.random(4000) < q, np.where(truth, 1, -1), np.where(truth, -1, 1)) * (rng.random(4000) < 0.8) for q in (0.95, 0.9, 0.6)], axis=1).astype(float)
    posterior, right, share = P.reliabilities(votes)
    assert abs(right[0] - 0.95) < 0.04 and abs(right[2] - 0.6) < 0.06 and abs(share - 0.4) < 0.05
    assert ((posterior > 0.5) == truth).mean() > 0.9


def test_tables(spark):
    rows = [(i, t, "x") for i, (t, _) in enumerate(CASES * 3)] + [(90, None, "x"), (91, "", "x"), (92, "x" * 50_000, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, kind string")
    got = {(r.doc_id, r.kind, r.val) for r in P.personal_spans(df).collect()}
    assert got == {(i, k, v) for i, (_, w) in enumerate(CASES * 3) for k, v in w}
    clean = {r.doc_id: r.masked for r in P.masked_documents(df).collect()}
    assert clean[90] is None and clean[91] == "" and "Fynsen" not in clean[0] and len(clean) == len(rows)
    assert P.personal_spans(df.where("doc_id > 500")).count() == 0


def test_names_outside_the_list():
    """With a random half of the listed given names withheld, names with those given names are still found, by what the corpus teaches."""
    import os
    import random

    import pyarrow.parquet as pq

    root = "/root/testdata/sf0.1"
    if not os.path.exists(root):
        pytest.skip("no test tables")
    texts = [t for t in pq.read_table(f"{root}/documents.parquet", columns=["text"]).column(0).to_pylist()[:2500] if t]
    listed = sorted(P.GIVEN_NAMES | P.GIVEN_NAMES_AR)
    half = set(random.Random(5).sample(listed, len(listed) // 2))
    whole, part = P.Model(texts), P.Model(texts, half)
    unseen = found = false = 0
    for t in texts:
        names = {(a, b) for a, b, k, _ in whole.spans(t) if k == "name"}
        got = {(a, b) for a, b, k, _ in part.spans(t) if k == "name"}
        for a, b in names:
            v = t[a:b].lower().replace("\n", " ")
            given = (v.split(", ")[1] if ", " in v else v).split(" ")[0]
            if not part.names.is_listed(given):
                unseen += 1
                found += (a, b) in got
        false += len(got - names)
    print(f"unseen {unseen}, found {found}, other {false}")
    assert unseen > 100 and found >= 0.9 * unseen and false <= 0.05 * unseen


def test_all_documents_teach(spark):
    """Names that stand only in the last of 6,000 documents are learned, and the table teaches exactly what its texts in one list do."""
    texts = [t for t, _ in CASES] * 600 + ["Contact: Jonas Quelbar, then home.", "The form was signed by Nadia Quelbar, who left.", "On Monday Bexley Quelbar gave a talk.", None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartitionByRange(5, "doc_id")
    got, want = P.train_from(df), P.Model([t for t in texts if t])
    assert "quelbar" in got.names.families
    for part in ("common", "before", "after", "families", "givens"):
        assert getattr(got.names, part) == getattr(want.names, part), part
    for kind in P.KINDS:
        assert np.allclose(got.reliability[kind], want.reliability[kind]) and np.allclose(got.weights[kind], want.weights[kind])
    found = {(r.doc_id, r.val) for r in P.personal_spans(df).where("doc_id >= 6000").collect()}
    assert found == {(6000, "Jonas Quelbar"), (6001, "Nadia Quelbar"), (6002, "Bexley Quelbar")}


def test_equal_rows_count_as_often_as_they_stand():
    votes = np.array([[1, 1, 0], [1, -1, 1], [-1, 0, -1]], float)
    times = np.array([5, 2, 9])
    one, many = P.reliabilities(votes, times=times.astype(float)), P.reliabilities(np.repeat(votes, times, axis=0))
    assert np.allclose(one[1], many[1]) and np.isclose(one[2], many[2])


def test_search_makes_few_calls(model):
    """The search of texts is most of the work of p10_found. Calls are counted instead of seconds, which depend on the machine."""
    import sys

    def calls(text: str) -> float:
        model.spans(text)
        n = 0

        def count(frame, event, arg):
            nonlocal n
            n += event in ("call", "c_call")

        sys.setprofile(count)
        try:
            model.spans(text)
        finally:
            sys.setprofile(None)
        return n / len(text.split())

    latin = "In the summer the readers of the old survey met Marta Fynsen near the harbour and wrote down what they saw, then Course Notes of the week were sent. "
    arabic = "قدم الطالب الجديد طلبا إلى القسم المختص في بداية الفصل الدراسي الثاني من العام. "
    got = calls(latin * 20), calls(arabic * 20)
    assert got[0] < 4.3 and got[1] < 9, got


def test_runs_of_arabic_words():
    """Windows taken a run at once are what each window by itself gives: particles, titles, wide gaps, a text's ends, words that are no whole token."""
    run = "قدم الطالب كريم بن فلور طلبا إلى السيد طارق في القسم"
    listed = P.GIVEN_NAMES | P.GIVEN_NAMES_AR
    texts = [run, f"{run}.", f". {run}. {run} {run}؛ x", f"Dr. {run} Institute of {run}", f"a{' ' * 50}{run}{' ' * 50}b c", f"a b{' ' * 38}{run}\n\n{run}3 ٤{run}x {run}ً", "ب" * 60 + f" {run} " + "ت" * 60 + f" ث {run} ج 12 د"]
    for text in texts:
        found = [tuple(c.values()) for c in P.searched(P.pa.array([text]), listed)[0].values.to_pylist()]
        around = P._Around(text)
        want = [(start, end, given, family, *around.both(start, end)) for m in P._ARABIC_RUN.finditer(text) for start, end, given, family in P._arabic_windows(m)]
        assert [(f[0], f[1], *f[3:]) for f in found if f[3] and f[3][0] >= "ء"] == want, text
        assert all(((-1 - f[2]) & P._LISTED > 0) == (f[3] in listed) for f in found if f[2] < 0)


def test_candidates_survive_packing():
    found, tokens = P.searched(P.pa.array([None, "", *[t for t, _ in CASES], "no span here", None]), P.GIVEN_NAMES | P.GIVEN_NAMES_AR)
    packed = P._packed(found)
    assert P._unpacked(packed).equals(found)
    for first, n in ((0, 2), (2, 5), (len(found) - 2, 2), (0, 0)):
        assert P._unpacked(packed.slice(first, n)).to_pylist() == found.slice(first, n).to_pylist()
    words = P._lower_words(tokens)
    assert words["questions"] == 1 and "fynsen" not in words
