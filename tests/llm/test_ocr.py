import random

import numpy as np

from quarrymill.llm import ocr as O
from quarrymill.llm.boosting import Boosted


def test_boosting_learns():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    model = Boosted(x[:1500], y[:1500])
    assert ((model.probability(x[1500:]) > 0.5) == y[1500:]).mean() > 0.97
    assert Boosted(np.zeros((0, 2)), np.zeros(0)).probability(np.zeros((2, 2))).max() < 0.5


def test_stroke_forms_join_confusions():
    strokes = O.Strokes([("†", "t"), ("0", "o"), ("1", "i"), ("1", "l")])
    for word in ("annealing", "volunteers", "model", "them", "children", "fellows"):
        for a, b in strokes.confusions:
            if a in word:
                assert strokes.form(word.replace(a, b, 1)) == strokes.form(word), (word, a, b)


WORDS = "committee department measurement laboratory translation seminar exchange students register evening transcript portfolio research station archive library volunteers university meeting annealing".split()


def scans(seed=1, documents=12, pages=5):
    rng = random.Random(seed)
    rows, truth = [], {}
    for d in range(documents):
        first = rng.randrange(10, 300)
        for p in range(pages):
            lines, defects = [], {"running_header", "page_number"}
            for _ in range(10):
                lines.append(" ".join(rng.choice(WORDS) for _ in range(6)))
            lines[-1] += "."
            lines[3] = lines[3] + " first-"
            lines[4] = "year " + lines[4]
            if p % 2:
                w = rng.choice(WORDS)
                lines[6], lines[7] = f"{lines[6]} {w[:4]}-", f"{w[4:]} {lines[7]}"
                defects.add("hyphenation")
            if p % 3 == 0:
                at = rng.randrange(2)
                lines[8] = lines[8].replace("e", "c", 1) if at and "e" in lines[8] else lines[8].replace("t", "†", 1)
                defects.add("misread")
            text = "\n".join([f"Annual Report {1990 + d}", f"- {first + p} -", "", *lines])
            rows.append((f"v{d}-{p}", f"doc{d}", p + 1 if p != 2 else None, text))
            truth[f"v{d}-{p}"] = defects
    rows.append(("plain", "docX", 1, " ".join(["first-year", "low-cost", *WORDS]) + "."))
    truth["plain"] = set()
    return rows, truth


def test_pages(spark):
    rows, truth = scans()
    rows += [rows[0], ("empty", "doc0", 9, ""), ("none", None, None, None)]
    df = spark.createDataFrame([(*r, 0.5, "x") for r in rows], "media_id string, document_id string, page_number int, ocr_text string, ocr_quality_score double, defect string")
    got = {}
    for r in O.page_defects(df).collect():
        got.setdefault(r.media_id, set()).add(r.defect)
    right = sum(got.get(m, set()) == t for m, t in truth.items())
    assert right >= 0.95 * len(truth), [(m, got.get(m), t) for m, t in truth.items() if got.get(m, set()) != t][:5]
    text = {r.media_id: r.repaired_text for r in O.repaired_pages(df).collect()}
    assert "Annual Report" not in text["v0-0"] and "\n" not in text["v0-1"] and "first-year" in text["v0-1"] and len(text) == len(truth)


def test_no_pages(spark):
    df = spark.createDataFrame([], "media_id string, document_id string, page_number int, ocr_text string")
    assert O.page_defects(df).count() == 0


def test_signs_are_learned(spark):
    """No sign is known beforehand: what stands for a letter in several words is found from the words alone, codes teach nothing."""
    counts = {w: 40 for w in WORDS} | {w.replace("t", "¤", 1): 1 for w in WORDS if "t" in w} | {w.replace("i", "7", 1): 1 for w in WORDS if "i" in w} | {f"b{n}": 3 for n in range(2, 9)} | {"hour": 9, "hourt": 1}
    words = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    strokes = O.learn_strokes(words)
    assert ("¤", "t") in strokes.signs and ("7", "i") in strokes.signs and not [s for s in strokes.signs if s[0].isalpha()]
    better = {r.word: r.better for r in O.corrections(words, words.select("word").where("false"), strokes).collect()}
    assert better == {w.replace("t", "¤", 1): w for w in WORDS if "t" in w} | {w.replace("i", "7", 1): w for w in WORDS if "i" in w}
