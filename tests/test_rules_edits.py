import datetime as dt

from pyspark.sql import functions as F

from strataline.functions import rules
from strataline.operators import edits, state


def _status(checked, key):
    return {r[key]: {c["name"]: c["status"] for c in r["qc_checks"]} for r in checked.collect()}


def test_rule_sets(spark):
    c = spark.createDataFrame([("a", "600001", "https://x", "X 2023年年度报告", 2023), ("b", "60001", "http://x", "X 2022 报告摘要", 2023), ("c", None, None, None, None)], "id string, stock_code string, source_url string, title string, report_year int")
    got = _status(state.checks(c, "id", rules.candidate_rules()), "id")
    assert set(got["a"].values()) == {"pass"} and got["b"] == {"stock_code_format": "fail", "source_url_https": "warn", "title_has_report_year": "fail", "title_is_full_report": "fail"}
    assert got["c"]["stock_code_format"] == "fail" and got["c"]["source_url_https"] == "warn"
    s = spark.createDataFrame([("a", "w", " T ", "https://x", "h"), ("b", "", " ", None, None)], "id string, work_uid string, title string, source_url string, metadata_hash string")
    assert sorted(_status(state.checks(s, "id", rules.scholarly_candidate_rules()), "id")["b"].values()) == ["fail", "fail", "fail", "warn"]
    full = ("d", "a", "600001", "X", 2023, "annual", "X 2023 报告", "s", "zh", "a" * 64, "2024-02-29")
    odd = ("e", None, "60001", "", None, "other", "X 2022", None, "zh", "A" * 64, "2023-02-29")
    m = spark.createDataFrame([full, odd], "document_uid string, asset_uid string, stock_code string, company_name string, report_year int, report_type string, title string, source_name string, language string, raw_file_hash string, announcement_date string")
    got = _status(state.checks(m, "document_uid", rules.financial_metadata_rules()), "document_uid")
    assert set(got["d"].values()) == {"pass"} and set(got["e"].values()) == {"warn"}
    a = spark.createDataFrame([("x/y.pdf", True, True, 10, 10, "h", "h", 3), ("../y.pdf", False, None, 10, 11, "h", "g", None), ("y..z/f.pdf", True, True, None, 11, "h", "h", 1)],
                              "raw_path string, exists boolean, pdf_valid boolean, file_size int, actual_size int, raw_file_hash string, actual_hash string, page_count int")
    got = _status(state.checks(a, "raw_path", rules.raw_asset_rules()), "raw_path")
    assert set(got["x/y.pdf"].values()) == {"pass"} == set(got["y..z/f.pdf"].values()) and got["../y.pdf"]["asset_path_safe"] == "fail" and got["../y.pdf"]["page_count_available"] == "warn"
    g = spark.createDataFrame([("g", 1, 5, "w", "a", "p"), ("h", 0, 0, None, "a", "p")], "governed_uid string, n_blocks int, char_count int, work_uid string, asset_uid string, input_path string")
    checked = state.checks(g, "governed_uid", rules.governed_document_rules())
    assert [r[0] for r in state.passing(g, checked, "governed_uid").select("governed_uid").collect()] == ["g"]
    results = checked.select("governed_uid", F.explode("qc_checks").alias("k")).select("governed_uid", "k.*")
    assert state.failed_gate(g, results, "governed_uid").count() == 3 and state.failed_gate(g.limit(0), results, "governed_uid").count() == 0


def test_claims(spark):
    t = lambda h: dt.datetime(2024, 1, 1, h)
    rows = [("a", "succeeded", 1, None, t(1), None, t(1)), ("b", "pending", 0, "a", t(1), None, t(3)), ("c", "pending", 0, "d", t(1), None, t(1)), ("d", "running", 1, None, t(1), t(9), t(1)),
            ("e", "running", 2, None, t(1), t(2), t(2)), ("f", "deferred", None, None, t(9), None, t(1)), ("g", "retry_wait", 1, "gone", t(1), None, t(1)), ("h", "pending", 0, None, None, None, t(1))]
    df = spark.createDataFrame(rows, "task_uid string, status string, attempts int, dependency_uid string, available_at timestamp, lease_until timestamp, created_at timestamp").withColumn("kind", F.lit("k"))
    assert {(r["task_uid"], r["status"]) for r in state.claimable(df, F.lit(t(5))).collect()} == {("b", "pending"), ("e", "retry_wait")}
    got = state.claimed(df, F.lit(t(5)), "me", 1).collect()
    assert [(r["task_uid"], r["status"], r["attempts"], r["owner"], r["lease_until"]) for r in got] == [("e", "running", 3, "me", t(6))]


TEXT = "Menu\nRevenue rose by 5 %.\nShare this page now\nThe end"


def test_programs():
    run = edits.run_program
    made = run(TEXT, '<extract>\nrm 1\n<edit>\nsub 3: "this "\nsub 3: " now"')
    assert (made.action, made.text, made.issues, made.fault) == ("edit", "Revenue rose by 5 %.\nShare page\nThe end", [], "")
    assert run(TEXT, "<keep>\n<extract>\n<keep>").text == TEXT
    assert run(TEXT, "<extract>\n<delete>").issues == ["financial_content_removed"] and run("x", "<extract>\n<delete>").issues == []
    assert run(TEXT, "<extract>\nrm 2\n<keep>").issues == ["financial_content_removed"]
    assert run(TEXT, "<extract>\nrm 1-3\n<keep>", protect=False).issues == ["retention_below_minimum"]
    assert run(TEXT, "<extract>\n<rewrite>\nRevenue rose by 6 %. And a good deal of other text.", rewrite=True).issues == ["financial_markers_changed"]
    assert run(TEXT, "<extract>\n<rewrite>\nRevenue rose by 5 %. <keep> and much more text here").issues == ["rewrite_disabled", "empty_or_leaked_program"]
    faults = {
        "<keep>": "missing_extract", "<extract>\nrm 1": "missing_decision", "<keep>\n<extract>\n<delete>": "conflicting_decisions", "<extract>\n<keep>\n<keep>": "multiple_decisions",
        "<extract>\n<keep>\nrm 1": "unexpected_payload", "<extract>\nrm 9\n<keep>": "line_out_of_range", "<extract>\nrm 2-1\n<keep>": "line_out_of_range",
        "<extract>\nrm 1\n<edit>\nrm 1-2": "overlapping_operations", "<extract>\nrm 1\n<edit>\nsub 1: \"M\"": "line_out_of_range_or_removed", "<extract>\n<edit>\nsub 3: \"a\"": "substring_missing_or_ambiguous",
        "<extract>\n<edit>\nsub 3: \"Share\"\nsub 3: \"are\"": "overlapping_operations", "<extract>\n<edit>\nsub 3: \"\"": "invalid_substring", "<extract>\nsub 3: \"Share\"\n<keep>": "invalid_operation",
        "<extract>\n<edit>": "empty_edit", "<extract>\ndrop 1\n<keep>": "invalid_operation", "": "missing_extract",
    }
    for program, fault in faults.items():
        assert (run(TEXT, program).fault, run(TEXT, program).text) == (fault, TEXT)


def test_refined(spark):
    rows = spark.createDataFrame([(1, TEXT, "<extract>\nrm 1\n<keep>"), (2, TEXT, "<extract>\n<delete>"), (3, TEXT, None), (4, None, "x"), (5, "", "nonsense")], "id long, text string, program string").withColumn("action", F.lit("clash"))
    got = {r["id"]: r for r in edits.refined(rows, "id").collect()}
    assert got[1]["text"] == TEXT[5:] and got[2]["text"] == TEXT and got[2]["issues"] and got[3]["action"] == "keep" and got[5]["fault"] == "missing_extract" and 4 not in got
