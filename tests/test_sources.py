import gzip

from pyspark.sql import functions as F

from quarrymill.plans import stages
from quarrymill.sources import files
from quarrymill.streaming import tail


def test_json_lines(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id bigint, t string")
    where = str(tmp_path / "rows")
    files.write_json_lines(df, where)
    files.write_json_lines(df, where)
    (tmp_path / "rows" / "bad.json").write_text('{"id": 3}\n{broken\n\n')
    rows, bad = files.read_json_lines(spark, where, "id bigint, t string")
    assert sorted((r.id, r.t) for r in rows.collect()) == [(1, "a"), (2, None), (3, None)]
    assert [r.line for r in bad.collect()] == ["{broken"]


def test_tree_and_sitemap(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "b" / "x.md").write_bytes(b"caf\xe9")
    (tmp_path / "a" / "y.txt").write_text("no")
    assert [r.text for r in files.read_tree(spark, str(tmp_path)).collect()] == ["caf�"]
    xml = b'<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc> https://x.org/1 </loc></url></urlset>'
    index = b"<sitemapindex><sitemap><loc>https://x.org/s.xml</loc></sitemap></sitemapindex>"
    df = spark.createDataFrame([(xml,), (gzip.compress(index),), (b"<broken",), (None,)], "content binary")
    assert {(r.kind, r.url) for r in files.sitemap_entries(df).collect()} == {("page", "https://x.org/1"), ("sitemap", "https://x.org/s.xml")}


def test_journal_and_upsert(spark):
    journal = spark.createDataFrame([("k", 1, "old"), ("k", 3, "new"), ("j", 2, None)], "key string, sequence int, value string")
    assert {(r.key, r.value) for r in files.compact_journal(journal).collect()} == {("k", "new"), ("j", None)}
    schema = "release_id string, record_id string, row_id bigint, updated_at timestamp, t string"
    stored = spark.createDataFrame([("r1", "a", 1, None, "a1"), ("r2", "a", 2, None, "a2")], schema)
    new = spark.createDataFrame([("r1", "a", 5, None, "a5"), ("r1", "a", 6, None, "a6"), ("r2", "a", 7, None, "a7")], schema)
    releases = spark.createDataFrame([("r1", "building"), ("r2", "active")], "release_id string, status string")
    got = files.upserted(stored, new, ["release_id", "record_id"], releases)
    assert {(r.release_id, r.t) for r in got.collect()} == {("r1", "a6"), ("r2", "a2")}


def test_stream_goes_on_where_it_ended(spark, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "check")
    schema = "event_type string, user_id bigint, value double, ts timestamp"
    rows = lambda hour: spark.createDataFrame([("a", 1, 1.0, hour), ("a", 2, 2.0, hour), ("b", 1, 5.0, hour)], "event_type string, user_id bigint, value double, t string").select("event_type", "user_id", "value", F.to_timestamp("t").alias("ts"))
    seen = []
    write = lambda df, n: seen.append({(r.event_type, r.events, r.total) for r in df.collect()})
    rows("2024-01-01 01:10:00").write.mode("append").parquet(source)
    tail.drain(tail.window_counts(tail.follow(spark, source, schema)), write, checkpoint, "update")
    rows("2024-01-01 01:50:00").write.mode("append").parquet(source)
    tail.drain(tail.window_counts(tail.follow(spark, source, schema)), write, checkpoint, "update")
    assert {("a", 2, 3.0), ("b", 1, 5.0)} in seen and {("a", 4, 6.0), ("b", 2, 10.0)} in seen
    assert tail.session_counts(spark.read.parquet(source)).where("user_id = 1").count() == 2


def test_stages_resume(spark, tmp_path):
    ran = []

    @stages.stage("t_first")
    def first(spark, tables):
        ran.append("first")
        return tables["n"].withColumn("x", F.col("id") + 1)

    @stages.stage("t_second")
    def second(spark, tables):
        ran.append("second")
        return tables["t_first"].where("x > 1")

    inputs = {"n": spark.range(3)}
    folder = str(tmp_path)
    stages.run_stages(spark, ["t_first", "t_second"], folder, inputs, stop_after="t_first")
    out = stages.run_stages(spark, ["t_first", "t_second"], folder, inputs)
    assert ran == ["first", "second"] and out["t_second"].count() == 2
    stages.run_stages(spark, ["t_first", "t_second"], folder, inputs, restart_at="t_second")
    assert ran == ["first", "second", "second"]
