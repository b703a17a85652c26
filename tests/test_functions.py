from pyspark.sql import functions as F

from quarrymill.functions import text as T
from quarrymill.functions import urls as U


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "v string").select(column(F.col("v")).alias("x")).first().x


def test_text_normalisation(spark):
    assert one(spark, T.clean, "  a \n\t b ") == "a b"
    assert one(spark, T.clean, None) is None
    assert one(spark, T.fold, "Große  STRASSE") == "grosse strasse"
    assert one(spark, T.words, "Été 2020: l'an_1") == ["été", "2020", "l", "an", "1"]
    assert one(spark, T.words, None) == []
    assert one(spark, T.sentences, "In 2020. Then? Yes!\nNo") == ["In 2020.", "Then?", "Yes!", "No"]
    assert one(spark, T.sentences, "") == []


def test_token_estimate(spark):
    assert one(spark, T.token_estimate, "abcd efghi.") == 1 + 2 + 1
    assert one(spark, T.token_estimate, "é") == 2
    assert one(spark, T.token_estimate, "") == 0


def test_urls(spark):
    assert one(spark, U.normalize, "HTTPS://WWW.Ex.org:443//a//b/?utm_source=x&b=2&a=1#top") == "https://www.ex.org/a/b?a=1&b=2"
    assert one(spark, U.normalize, "mailto:a@b.c") == "mailto:a@b.c"
    assert one(spark, U.normalize, None) is None
    assert one(spark, U.family, "https://x.org/ar/news/1?q=1") == "https://x.org/news/1"
    assert one(spark, U.host, "https://X.org:8443/a") == "x.org"
    assert one(spark, U.host, None) == ""
    assert one(spark, U.page_type, "https://x.org/news/a") == "news_or_event"
    assert one(spark, U.path_language, "https://x.org/fr") == "fr"
    assert one(spark, lambda c: U.on_host(c, "x.org"), "https://a.x.org/") is True
    assert one(spark, lambda c: U.on_host(c, "x.org"), "https://ax.org/") is False


def test_stable_ids(spark):
    row = spark.createDataFrame([("a", None, "")], "a string, b string, c string").select(T.stable_id(40, F.col("a"), F.col("b"), F.col("c")).alias("x"), T.stable_fraction(F.col("a")).alias("f")).first()
    assert row.x == "86f7e437faa5a7fce15d1ddcb9eaeaea377667b8" and 0 <= row.f < 1
