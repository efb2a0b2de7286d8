from pyspark.sql import functions as F

from strataline.functions import contracts as C


def test_messages(spark):
    m = lambda *roles: [(r, "text <image>") for r in roles]
    data = [(1, m("system", "user", "assistant")), (2, m("user", "assistant")), (3, [("system", " "), ("user", "x"), ("assistant", "y")]), (4, None), (5, []), (6, m("system", "user", "assistant", "user", "assistant")), (7, [("system", None), ("user", "x"), ("assistant", "y")])]
    df = spark.createDataFrame(data, "id int, m array<struct<role:string,content:string>>")
    assert {r["id"]: r["ok"] for r in df.select("id", C.valid_messages(F.col("m")).alias("ok")).collect()} == {1: True, 2: False, 3: False, 4: False, 5: False, 6: True, 7: False}
    assert {r["id"] for r in df.where(C.valid_messages(F.col("m"), 3)).collect()} == {1}
    assert df.where("id = 6").select(C.image_marks(F.col("m"))).first()[0] == 5


def test_regions_answers_markers_ladders(spark):
    df = spark.createDataFrame([(1, [[0, 0, 5, 5]]), (2, [[5, 0, 5, 5]]), (3, []), (4, None), (5, [[0, 0, 1001, 5]]), (6, [[0, 0]])], "id int, b array<array<int>>")
    assert {r["id"] for r in df.where(C.valid_regions(F.col("b"))).collect()} == {1}
    a = spark.createDataFrame([(" Accept", {"x": True}), ("accept", {"x": False}), ("accept", None), ("reject", None), ("?", None)], "s string, c map<string,boolean>")
    assert [r[0] for r in a.select(C.accepted_answer(F.col("s"), F.col("c"))).collect()] == ["accept", "invalid", "invalid", "reject", "invalid"]
    t = spark.createDataFrame([("1 2 2", "2 1 2"), ("1 2", "1 2 2")], "x string, y string")
    assert [r[0] for r in t.select(C.same_markers(F.col("x"), F.col("y"), r"\d+")).collect()] == [True, False]
    e = spark.createDataFrame([("Read timed out",), ("HTTP 404",), ("odd",), (None,)], "m string")
    assert [r[0] for r in e.select(C.download_problem(F.col("m"))).collect()] == ["timeout", "missing", "other", None]
