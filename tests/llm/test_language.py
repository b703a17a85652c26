import pytest

from quarrymill.llm import language as L

TEXT = {
    "en": "The committee asked the department to simplify the form. Students who fail the course may repeat it once. The library stays open late in the evening.",
    "de": "Der Ausschuss fragte nach dem neuen Formular. Die Studierenden dürfen den Kurs einmal wiederholen. Am 9. März bleibt die Bibliothek abends länger geöffnet.",
    "fr": "Le comité a demandé de simplifier le formulaire. Les étudiants peuvent suivre le cours une seconde fois. La bibliothèque reste ouverte le soir.",
    "es": "El comité pidió simplificar el formulario de la escuela. Los estudiantes pueden repetir el curso una vez. La biblioteca sigue abierta por la noche.",
    "ar": "طلبت اللجنة تبسيط نموذج التقديم. يمكن للطلبة إعادة المقرر مرة واحدة. تبقى المكتبة مفتوحة حتى المساء.",
}


@pytest.fixture(scope="module")
def trees():
    rows = [(k, v) for k, v in TEXT.items() for _ in range(4)] + [("fr", TEXT["ar"])]
    return L.train(rows)


def test_code_lengths_are_probabilities(trees):
    import numpy as np

    p = np.exp2(-trees.costs[2].reshape(-1, trees.size).astype(float)).sum(axis=1)
    assert abs(p - 1).max() < 0.05


def test_labels():
    assert [L.label_code(x) for x in ("en-US", "en_GB", " en ", "English", "العربية", "français", "pt-BR", "", None, "und", "N/A")] == ["en", "en", "en", "en", "ar", "fr", None, None, None, None, None]


def test_segments(trees):
    for lang, text in TEXT.items():
        (s,) = L.classify(trees, [text])[0]
        assert s[0] == lang and s[2] > 0.99
    mixed = L.classify(trees, [TEXT["en"] + "\n---\n" + TEXT["ar"]])[0]
    assert [s[0] for s in mixed] == ["en", "ar"]
    assert L.classify(trees, [None, "", "123 ...", "\n"]) == [[], [], [], []]


def test_cases(spark, trees):
    rows = [(1, TEXT["en"], "English", "x"), (2, TEXT["de"], "en", "x"), (3, TEXT["fr"], None, "x"), (4, TEXT["en"] + "\n" + TEXT["es"], "en", "x"), (5, None, "en", "x"), (6, "", " ", "x"), (7, TEXT["ar"], "ar-AE", "x")]
    df = spark.createDataFrame(rows, "row_id bigint, retrieval_text string, language string, lang string")
    from pyspark.sql import functions as F

    got = L.language_cases(L.language_segments(df, trees, "row_id", "retrieval_text", "language").withColumn("tbl", F.lit("t")))
    assert {(r.rec_key, r.lang) for r in got.collect()} == {("2", "de"), ("3", "fr"), ("4", "en"), ("4", "es")}
