import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.operators.collect import called, cleaned, concurrency, fan_out, filter_models, games_of, golden_items, golden_rows, limited, retry_policy, store_answers, with_metadata, with_second_pass
from plumbline.sources import sinks
from plumbline.sources.tables import current_numbers, current_rows, latest_partition
from plumbline.streaming.daily import daily_sessions


def test_current_rows(spark):
    df = spark.createDataFrame([(1, "a", "2"), (1, "b", "3"), (1, "b", "3"), (2, "c", None), (None, "d", "9")], "id long, v string, dt string")
    assert sorted((r.id, r.v) for r in current_rows(df, "id", "dt").collect()) == [(1, "b"), (2, "c")]
    got = current_numbers(df.withColumn("n", F.col("dt").cast("long")), "id", F.col("n"), ["n"])
    assert sorted((r.id, r.n) for r in got.collect()) == [(1, 3), (2, None)]
    assert [r.v for r in latest_partition(df).collect()] == ["d"]
    assert latest_partition(df.limit(0)).count() == 0


def test_coerced(spark):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType()), T.StructField("c", T.DoubleType())])
    df = spark.createDataFrame([("12", "nan", 1), ("x", "ok", 2)], "a string, b string, extra int")
    assert [tuple(r) for r in sinks.coerced(df, schema).collect()] == [(12, None, None), (None, "ok", None)]


def test_partitions_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.write_partitions(spark.createDataFrame([(1, "x"), (2, "y")], "v int, dm string"), path, ["dm"])
    assert sinks.write_partitions(spark.createDataFrame([(3, "y")], "v int, dm string"), path, ["dm"])
    assert not sinks.write_partitions(spark.createDataFrame([], "v int, dm string"), path, ["dm"])
    assert sorted((r.v, r.dm) for r in spark.read.parquet(path).collect()) == [(1, "x"), (3, "y")]
    assert [r.v for r in sinks.read_where(spark, path, {"dm": "y"}, "v > 1", 5).collect()] == [3]


def test_merge_can_overwrite_what_it_read(spark, tmp_path):
    path = str(tmp_path / "g")
    spark.createDataFrame([(1, 0), (2, 1), (3, None)], "id int, is_golden int").write.parquet(path)
    new = spark.createDataFrame([(9, 1, "n")], "id int, is_golden int, note string")
    sinks.merge_golden(spark.read.parquet(path), new).write.mode("overwrite").parquet(path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 3, 9]
    assert sinks.next_ids(spark.read.parquet(path), "id") == 10 and sinks.next_ids(spark.read.parquet(path).limit(0), "id") == 1


def test_csv_round_trip_and_missing_columns(spark, tmp_path):
    path, schema = str(tmp_path / "c"), T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    sinks.write_csv(spark.createDataFrame([(1, "x,y"), (2, None)], schema), path)
    assert sorted(tuple(r) for r in sinks.read_csv(spark, path, schema).collect()) == [(1, "x,y"), (2, None)]
    with pytest.raises(ValueError, match="missing columns: z"):
        sinks.read_csv(spark, path, T.StructType([T.StructField("z", T.LongType())]))
    assert "| 1 | x,y |" in sinks.markdown(spark.createDataFrame([(1, "x,y")], schema), "T")


@pytest.mark.parametrize(
    "status,attempt,slow,after,again,delay",
    [(401, 0, False, None, False, 0), (403, 0, False, None, False, 0), (429, 0, False, None, True, 10), (500, 1, False, None, True, 8), (503, 1, True, None, True, 100), (None, 0, True, None, True, 10), (429, 3, True, None, True, 240), (None, 2, False, None, True, 8), (429, 0, False, 7.0, True, 7), (500, 4, False, None, False, 0), (429, 3, False, None, True, 80), (429, 4, False, None, False, 0)],
)
def test_retry_policy(status, attempt, slow, after, again, delay):
    got = retry_policy(status, attempt, slow, after)
    assert (got.again, got.delay) == (again, delay)


def test_second_pass_only_sees_failures(spark):
    q = spark.createDataFrame([(i, f"q{i}") for i in range(40)], "query_id long, raw_query string")
    answered = fan_out(q, "raw_query", ["m1", "m2"])
    done = with_second_pass(answered, lambda df: df.withColumn("answer", F.lit("again")))
    assert done.count() == 80 and done.where("answer is null").count() == 0
    assert done.where("attempts = 2").count() == answered.where("answer is null").count() > 0


def test_golden_rows(spark):
    items = spark.createDataFrame([(1, "q", "yes", "no"), (2, "q", "same", " same"), (3, None, "a", "b"), (4, "q", "g。", "b")], "item long, question string, good string, bad string")
    rows = golden_rows(items, "item", 100, 1_700_000_000, 788, 90).collect()
    assert sorted({r.query_id for r in rows}) == [101, 102] and len({r.answer_id for r in rows}) == 4
    assert sum('"correct":true' in r.generation_metadata for r in rows) == 2
    assert all(r.answer.endswith("**模型A**" if r.side == 0 else "**模型B**") and "。。" not in r.answer for r in rows)
    many = spark.range(25_000).selectExpr("id as item", "'q' as question", "'g' as good", "'b' as bad")
    ids = golden_rows(many, "item", 9_999, 1_700_000_000, 788, 90, hints=None)
    assert ids.select("answer_id").distinct().count() == 50_000 and ids.agg(F.max("query_id")).first()[0] == 34_999


def test_golden_items_are_checked(spark):
    kind = "item int, question string, answers array<struct<text: string, correct: boolean>>"
    fine = [("left。 如果左边的表述正确，请全部选择**模型B** ", True), ("right", False)]
    rows = [(1, "Which?", fine), (2, "Which?", fine[:1]), (3, "Which?", [("a", True), ("b", True)]), (4, "Other?", fine), (5, "Which?", [(" ", True), ("b", False)]), (6, "Which?", [("a", None), ("b", True)]), (7, None, fine), (8, "Which?", None)]
    got = {r.item: (r.good, r.bad) for r in golden_items(spark.createDataFrame(rows, kind), "item", "Which?").collect()}
    assert got == {1: ("left", "right"), 6: ("b", "a")}


def test_models_limits_and_games(spark):
    models = spark.createDataFrame([("Orbit", "orbit-api"), ("Heron", None)], "model_name string, api string")
    assert [r.model_name for r in filter_models(models, ["ORBIT-API", "x"], api_name="api").collect()] == ["Orbit"]
    assert filter_models(models, []).count() == 2 and filter_models(models, ["heron"]).count() == 1
    model = {"model_name": "m", "provider": "p", "concurrent_limit": "4"}
    assert [concurrency(model), concurrency(model, {"all": "2", "p": "x", "m": "7"}), concurrency({"concurrent_limit": "z"}), concurrency(model, {"all": "2", "p": "3"})] == [4, 7, 10, 3]
    tasks = spark.range(200).selectExpr("id", "if(id % 2 = 0, 'a', 'b') as model")
    spread = limited(tasks, "model", "id", {"a": 3, "b": 1}).withColumn("part", F.spark_partition_id())
    assert {r.model: r.n for r in spread.groupBy("model").agg(F.countDistinct("part").alias("n")).collect()} == {"a": 3, "b": 1}
    sets = spark.createDataFrame([(1, "A", 10, "2024-01"), (1, "A", 12, "2024-02"), (1, "A", 11, "2024-02"), (2, "B", None, None)], "game_id int, game_name string, set_id int, dm string")
    assert sorted((r.game_id, r.set_id) for r in games_of(sets, "dm").collect()) == [(1, 12), (2, None)]


def test_calls_are_repeated_by_the_policy(spark):
    class Refused(Exception):
        def __init__(self, status):
            super().__init__(f"status {status}")
            self.status = status

    tries = {}

    def call(text, model):
        tries[text] = tries.get(text, 0) + 1
        if text == "bad" or (text == "late" and tries[text] < 3):
            raise Refused(403 if model == "closed" else 500)
        return f"{model}: {text}"

    tasks = spark.createDataFrame([("ok", "m"), ("late", "m"), ("bad", "m"), ("bad", "closed")], "q string, model string").coalesce(1)
    got = {(r.q, r.model): (r.answer, r.tries, r.error) for r in called(tasks, "q", "model", call, attempts=4, sleep=lambda s: None).collect()}
    assert got == {("ok", "m"): ("m: ok", 1, None), ("late", "m"): ("m: late", 3, None), ("bad", "m"): (None, 4, "status 500"), ("bad", "closed"): (None, 1, "status 403")}


def test_answers_are_stored_with_metadata(spark, tmp_path):
    path = str(tmp_path / "a")
    rows = spark.createDataFrame([(1, "Go left. [1]", "m", "2024-01", 7, 3), (2, "  ", "m", "2024-01", 7, 3), (3, None, "m", "2024-01", 7, 4)], "answer_id long, text string, model string, dm string, game_id int, model_id int")
    told = with_metadata(cleaned(rows, "text"), "model").withColumn("answer_content", F.col("clean_text"))
    assert store_answers(told.select("answer_id", "answer_content", "generation_metadata", "dm", "game_id", "model_id"), path)
    got = spark.read.parquet(path).collect()
    assert [(r.answer_id, r.answer_content, r.model_id) for r in got] == [(1, "Go left.", 3)]
    assert '"raw_equals_clean":false' in got[0].generation_metadata and '"citations":1' in got[0].generation_metadata


def test_reports_registry_and_failed_queries(spark, tmp_path):
    df = spark.createDataFrame([("g1", "a", 0.12345, 1), ("g1", "b", None, 2), ("g2", "c", 1.0, 3)], "game string, model string, s double, n int")
    text = sinks.markdown(df, "Strengths", {"s": 2}, within=["game"])
    assert "### g1" in text and "| a | 0.12 | 1 |" in text and "| b |  | 2 |" in text and text.count("| model | s | n |") == 2
    assert "| 299 |" in sinks.markdown(spark.range(300), "All") and sinks.markdown(df.limit(0), "None").count("|") > 4
    sinks.write_csv(df, str(tmp_path / "r.csv"), mark=True)
    raw = (tmp_path / "r.csv").read_bytes()
    assert raw.startswith(b"\xef\xbb\xbfgame,model") and len(raw.splitlines()) == 4
    sinks.write_registry(spark, [{"id": 1, "model_name": "m", "provider": "p"}], str(tmp_path / "m"), "2024-01")
    sinks.write_registry(spark, [{"id": 2, "model_name": "n", "provider": "p", "base_model": "b"}], str(tmp_path / "m"), "2024-01")
    assert [(r.model_id, r.base_model, r.params) for r in spark.read.parquet(str(tmp_path / "m")).collect()] == [(2, "b", "{}")]
    assert sinks.table_name("answers", "TEST") == "answers_test" and sinks.table_name("answers") == "answers"
    kind = T.StructType([T.StructField("game", T.StringType()), T.StructField("n", T.IntegerType())])
    sinks.write_json(df.select("game", "n"), str(tmp_path / "failed"))
    assert sinks.read_json(spark, str(tmp_path / "failed"), kind).count() == 3 and sinks.read_json(spark, str(tmp_path / "none"), kind).count() == 0
    assert sinks.preview(df, 1) == ['{"game":"g1","model":"a","s":0.12345,"n":1}']


def test_tables_are_made_once(spark):
    kind = T.StructType([T.StructField("v", T.LongType()), T.StructField("dm", T.StringType())])
    for _ in range(2):
        sinks.create_if_missing(spark, "made_once", kind, ["dm"])
    try:
        assert spark.table("made_once").columns == ["v", "dm"]
    finally:
        spark.sql("DROP TABLE made_once")


def test_scratch_is_cleared(spark):
    from plumbline.session import Scratch, clear_scratch

    kept, Scratch.roots = Scratch.roots, []
    saved = Scratch(spark, "t").save(spark.range(3))
    assert saved.count() == 3 and clear_scratch(spark) == 1 and clear_scratch(spark) == 0
    Scratch.roots = kept


def test_stream_equals_batch(spark, tmp_path):
    rows = [(i, 100 + i % 3, 5 if i % 2 else 1, 1_700_000_000 + 40_000 * i) for i in range(8)] + [(1, 101, 5, 1_700_040_000), (9, None, 5, None)]
    source = str(tmp_path / "in")
    spark.createDataFrame(rows, "id long, user_id long, status long, start_at long").coalesce(1).write.parquet(source)
    batch = daily_sessions(spark.read.parquet(source)).collect()
    stream = daily_sessions(spark.readStream.schema(spark.read.parquet(source).schema).parquet(source))
    query = stream.writeStream.format("memory").queryName("daily").outputMode("update").start()
    query.processAllAvailable()
    query.stop()
    assert sorted(map(tuple, spark.table("daily").collect())) == sorted(map(tuple, batch))
