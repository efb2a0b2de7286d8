import decimal

import pytest
from hypothesis import given
from hypothesis import strategies as st

from strataline.operators import programs as P
from strataline.operators import state
from strataline.plans import queries_state


def test_trees():
    nodes = {"a": "12.5", "b": "10"}
    assert P.rounded(P.evaluate({"op": "growth", "args": ["a", "b"]}, nodes), 2) == "25.00"
    assert P.rounded(P.evaluate({"op": "percentage", "args": [{"op": "difference", "args": ["a", "b"]}, "b"]}, nodes), 1) == "25.0"
    assert P.rounded(P.evaluate({"op": "ratio", "args": [1, 8]}, {}), 2) == "0.13"
    for bad in ({"op": "ratio", "args": [1, 0]}, {"op": "x", "args": [1, 2]}, "c", {"op": "sum", "args": [1]}, None, "NaN"):
        assert P.evaluate(bad, nodes) is None


@given(st.decimals(-(10**12), 10**12, places=4), st.decimals(-(10**12), 10**12, places=4))
def test_difference_undoes_sum(a, b):
    total = P.evaluate({"op": "sum", "args": [str(a), str(b)]}, {})
    assert P.evaluate({"op": "difference", "args": [str(total), str(b)]}, {}) == decimal.Decimal(a)


def test_run_programs(spark):
    df = spark.createDataFrame([(1, '{"op": "sum", "args": ["x", 2]}', '{"x": "1.005"}', "c"), (2, None, None, "c"), (3, "broken", "{}", "c"), (4, "5", None, "c")], "id int, p string, n string, value string")
    assert {tuple(r) for r in P.run_programs(df, "id", "p", "n").collect()} == {(1, "3.01"), (2, None), (3, None), (4, "5.00")}
    assert P.run_programs(df.limit(0), "id", "p", "n").count() == 0


def test_objects_and_leads():
    assert P.first_object('text ```json\n{"a": [1, 2,],}\n``` more') == {"a": [1, 2]}
    assert P.first_object('so {x} then {"b": {"c": 1}} end') == {"b": {"c": 1}}
    assert P.first_object("none") is None and P.first_object(None) is None and P.first_object("[1]") is None
    assert P.lead_sentences("# Head\nOne is here. Two is here. " + "x" * 400, 40) == "One is here. Two is here."
    assert P.lead_sentences("y" * 50, 10) == "y" * 10 and P.lead_sentences("", 10) == ""


def test_task_states(spark):
    data = [("t1", 1, "started"), ("t1", 2, "failed"), ("t2", 1, "started"), ("t2", 2, "succeeded"), ("t3", 1, "started"), ("t3", 2, "deferred"), (None, 1, "started")]
    data += [("t4", k, "failed") for k in range(5)]
    got = {r["task"]: (r["status"], r["attempts"], r["wait_seconds"]) for r in state.task_states(spark.createDataFrame(data, "task string, at int, status string"), "task", "at", "status").collect()}
    assert got == {"t1": ("retry_wait", 2, 10.0), "t2": ("succeeded", 1, None), "t3": ("deferred", 0, None), "t4": ("failed", 5, None)}


def test_bootstrap(spark):
    df = spark.createDataFrame([("a", float(k % 2), k) for k in range(200)] + [("b", 1.0, 1), ("b", None, 2)], "g string, v double, id int")
    got = {r["g"]: r for r in state.bootstrap_mean(df, "v", ["g"], rounds=400).collect()}
    assert got["a"]["mean"] == 0.5 and 0.40 < got["a"]["low"] < 0.47 and 0.53 < got["a"]["high"] < 0.60
    assert got["b"]["low"] == pytest.approx(1.0) == got["b"]["high"]
    whole = state.bootstrap_mean(df, "v", [], rounds=100).first()
    assert whole["low"] <= whole["mean"] <= whole["high"]
    assert state.bootstrap_mean(df.limit(0), "v", ["g"], rounds=10).count() == 0


def test_bootstrap_query_draws_all_resamples(spark, monkeypatch):
    df = spark.createDataFrame([(k, "ab"[k % 2], float(k * k % 37)) for k in range(40)], "event_id int, event_type string, value double")
    monkeypatch.setattr(queries_state, "read_table", lambda *_: df)
    want = state.bootstrap_mean(df, "value", ["event_type"], rounds=2000)
    order = lambda made: sorted(map(tuple, made.collect()))
    assert order(queries_state.bootstrap_intervals(spark, "")) == order(want)
