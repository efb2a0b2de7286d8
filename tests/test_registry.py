import datetime as dt

from pyspark.sql import functions as F

from strataline.operators import registry as R


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_years_batches_numbers(spark):
    t = spark.createDataFrame([("a", 2020, 2021), ("b", 2022, None), ("c", 2025, 2024), ("d", None, None), ("e", 1980, 1990)], "t string, start_year int, end_year int")
    assert rows(R.target_years(t, 2024).select("t", "year")) == {("a", 2020), ("a", 2021), ("b", 2022), ("b", 2023), ("d", 2023), ("e", 1990)}
    y = spark.createDataFrame([(None,), (2020,), (1999,)], "y int")
    assert [r[0] for r in y.select(R.within_years(F.col("y"), 2000, 2024)).collect()] == [True, True, False]
    b = spark.createDataFrame([(["b", None], ["a", "b"]), (None, None)], "x array<string>, y array<string>")
    assert [r[0] for r in b.select(R.batch_ids(F.col("x"), F.col("y"))).collect()] == [["a", "b"], []]
    new = spark.createDataFrame([("g", k) for k in range(5)] + [("h", 1), (None, 2)], "grp string, id long").withColumn("_last", F.lit("clash"))
    used = spark.createDataFrame([("g", 7), ("g", 3)], "grp string, number long")
    got = R.numbered(new.drop("_last"), used, "grp", "id").collect()
    assert sorted(r["number"] for r in got if r["grp"] == "g") == [8, 9, 10, 11, 12] and {r["number"] for r in got if r["grp"] != "g"} == {1} and len(got) == 7


def test_dispositions(spark):
    c = spark.createDataFrame([("u1", "h1", True), ("u2", "h2", False), ("u3", "h3", True), ("u4", "h3", True), ("u5", "h9", True), ("u6", None, True), ("u7", "h7", None)], "source_url string, content_hash string, valid boolean")
    held = spark.createDataFrame([("u1", "x"), ("u0", "h9"), (None, None)], "source_url string, content_hash string")
    assert {(r[0], r[3]) for r in R.report_dispositions(c, held).collect()} == {("u1", "reused"), ("u2", "quarantined"), ("u3", "success"), ("u4", "duplicate"), ("u5", "duplicate"), ("u6", "success"), ("u7", "quarantined")}
    s = spark.createDataFrame([("a", None, 1, True, None, None, None), ("b", "u", 1, True, "h", True, None), ("b2", "u", 2, True, "h", True, None), ("c", "v", 1, False, None, None, None), ("d", "w", 1, True, None, None, "timeout"), ("e", "x", 1, True, "z", False, None), ("f", "y", 1, True, "held", True, None)],
                              "work_uid string, file_url string, updated int, licence_ok boolean, content_hash string, valid boolean, error string")
    blocked = spark.createDataFrame([("b", "u", 1), ("b2", "u", 1)], "work_uid string, file_url string, updated int")
    got = R.scholarly_dispositions(s, blocked, spark.createDataFrame([("held",)], "content_hash string"))
    assert {(r["work_uid"], r["disposition"]) for r in got.collect()} == {("a", "metadata_only"), ("b", "blocked"), ("b2", "success"), ("c", "skipped"), ("d", "failed_retryable"), ("e", "failed_invalid"), ("f", "duplicate")}


def test_overrides(spark):
    r = spark.createDataFrame([("a", 2020, "x"), ("b", 2021, None)], "id string, year int, name string")
    o = spark.createDataFrame([("a", "year", "2022", 1), ("a", "year", "2023", 2), ("b", "year", "soon", 1), ("b", "name", "n", 1), ("a", "name", None, 3), ("zz", "year", "1", 1), ("a", "other", "1", 1)], "id string, field string, value string, at int")
    out, audit = R.overridden(r, o, "id", ["year", "name"])
    assert rows(out) == {("a", 2023, None), ("b", 2021, "n")}
    assert rows(audit) == {("a", "year", "2020", "2023", 2), ("a", "name", "x", None, 3), ("b", "year", "2021", "soon", 1), ("b", "name", None, "n", 1)}
    t = spark.createDataFrame([("year=2020\nname = a=b",), ("year=1\nyear=2",), ("foo=1",), ("year=",), ("year",), ("",)], "t string")
    made, fault = R.parsed_assignments(F.col("t"), ["year", "name"])
    got = [(r[0], r[1]) for r in t.select(made, fault).collect()]
    assert got == [({"year": "2020", "name": "a=b"}, None), (None, "repeated_field"), (None, "unknown_field"), (None, "empty_value"), (None, "no_assignment"), ({}, None)]


def test_sync_windows_versions(spark, tmp_path):
    runs = spark.createDataFrame([("s", "t", "success", 1, "c1"), ("s", "t", "failed", 2, "c2"), ("s", "u", "failed", 1, "x")], "source string, target string, status string, finished_at int, cursor string")
    assert rows(R.sync_state(runs)) == {("s", "t", 1, "c1")}
    w = spark.createDataFrame([("s", "live", "w1", 1, "finished"), ("s", "live", "w2", 2, "failed"), ("s", "live", "w3", 3, "pending"), ("s", "history", "h1", 1, "running")], "source string, lane string, window_id string, starts_at int, status string")
    assert rows(R.next_window(w)) == {("s", "live", "w2", 2), ("s", "history", "h1", 1)}
    a = spark.createDataFrame([("r1",), ("r2",)], "run_uid string")
    assert rows(R.interrupted(a, a.where("run_uid = 'r1'"))) == {("r2",)}
    v = spark.createDataFrame([("g", "v1", True), ("g", "v2", False), ("h", "v3", True)], "grp string, version_uid string, is_current boolean")
    out, audit = R.select_version(v, ["grp"], "v2", "me", F.lit(dt.datetime(2024, 1, 1)))
    assert rows(out) == {("g", "v1", False), ("g", "v2", True), ("h", "v3", True)} and {(r[0], r[1]) for r in audit.collect()} == {("v1", "demoted"), ("v2", "selected")}
    assert rows(R.select_version(v, ["grp"], "zz", "me", F.lit(1))[0]) == rows(v)
    path = str(tmp_path / "t")
    t = spark.createDataFrame([(1, "a"), (2, "b")], "x int, p string")
    R.replace_partition(t, path, "p")
    R.replace_partition(spark.createDataFrame([(3, "b")], "x int, p string"), path, "p")
    assert rows(spark.read.parquet(path).select("x", "p")) == {(1, "a"), (3, "b")}


def test_support_admission_conflicts(spark):
    c = spark.createDataFrame([("a", ["x", "y"], [["x"], ["y", "x"]]), ("b", ["x"], [["x"], ["z"], None]), ("c", None, None)], "id string, evidence array<string>, supports array<array<string>>")
    assert [(r["id"], r["missing"], r["surplus"]) for r in R.support_faults(c).collect()] == [("b", ["z"], [])]
    s = spark.createDataFrame([("s", "passed", "Good text"), ("s", "passed", "<think>x"), ("s", "passed", "　 \n"), ("s", "failed", "Good"), ("t", "passed", "Good"), ("s", "passed", None), ("s", "passed", "As an AI model I")], "source string, ocr_status string, text string")
    p = spark.createDataFrame([("s", "approved"), ("t", "denied")], "source string, training string")
    assert R.admitted(s, p).select("text").collect()[0][0] == "Good text"
    u = spark.createDataFrame([("r", 1, None), ("r", 2, 5)], "role string, a int, b int")
    assert rows(R.usage_sums(u, "role", ["a", "b"])) == {("r", 3, 5)}
    m = spark.createDataFrame([("1", "train", "c", ["i", "j"]), ("2", "test", "c", ["k"]), ("3", "test", "d", ["i"]), ("4", None, "d", None), ("5", "train", None, ["k", None])], "sample_id string, split string, content_hash string, image_hashes array<string>")
    assert rows(R.split_conflict_groups(m)) == {("content:c", 2), ("image:i", 2), ("image:k", 2)}
    assert R.first_in_order(u, [F.desc("a")], 1).collect()[0]["a"] == 2
