"""Run histories, resumed runs and details of withheld pages on literal rows."""

import json

import pytest

from gazetta.operators import lifecycle

STEP = "source_id string, at int, status string"


def steps(history):
    return [("s", k, status) for k, status in enumerate(history)]


@pytest.mark.parametrize(("history", "accepted", "state"), [
    (["NOT_STARTED", "OK", "RUNNING", "OK"], [0, 2, 3], "OK"),
    (["NOT_STARTED", "RUNNING", "RUNNING", "EMPTY", "RUNNING", "OK"], [0, 1, 3], "EMPTY"),
    (["RUNNING", "NOT_STARTED", "PARTIAL", "NOT_STARTED"], [1], "NOT_STARTED"),
    (["OK"], [], None), (["NOT_STARTED", "what", None, "RUNNING", "ERROR"], [0, 3, 4], "ERROR"),
])
def test_rejected_steps_leave_the_state(spark, history, accepted, state):
    folded = lifecycle.folded_states(spark.createDataFrame(steps(history), STEP))
    rows = {r["at"]: (r["before"], r["accepted"]) for r in folded.collect()}
    assert [k for k in sorted(rows) if rows[k][1]] == accepted
    now = None
    for k in sorted(rows):
        assert rows[k][0] == now
        now = history[k] if k in accepted else now
    last = lifecycle.final_states(folded).first()
    assert (last["status"], last["accepted"], last["rejected"]) == (state, len(accepted), len(history) - len(accepted))


def test_steps_with_values_that_break_a_rule_are_rejected(spark):
    kind = STEP + ", started_at string, finished_at string, candidate_count int, normal_collection_completed boolean, limitation string, error string"
    rows = [("s", 0, "NOT_STARTED", "", "", 0, False, "", ""), ("s", 1, "RUNNING", "", "", 0, False, "", ""), ("s", 2, "RUNNING", "t", "", 0, False, "", ""), ("s", 3, "OK", "t", "u", 0, True, "", ""), ("s", 4, "PARTIAL", "t", "u", 2, False, "slow", "")]
    folded = lifecycle.folded_states(spark.createDataFrame(rows, kind), values=True)
    assert sorted(r["at"] for r in folded.where("accepted").collect()) == [0, 2, 4]
    assert lifecycle.folded_states(spark.createDataFrame([], STEP)).collect() == []


def test_resume_plan(spark):
    names = ["done", "short", "open", "stale", "list", "text", "moved", "other", "new", "empty", "lost"]
    registry = spark.createDataFrame([(n, "r", 1, f"/{n}") for n in names], "source_id string, registry_id string, schema_version int, fixed_route string")
    runs = spark.createDataFrame([("done", "OK", 2), ("short", "OK", 3), ("open", "OK", 1), ("stale", "RUNNING", 0), ("list", "OK", 1), ("text", "PARTIAL", 1), ("moved", "PARTIAL", 0), ("empty", "EMPTY", 0), ("lost", "OK", 1)], "source_id string, status string, candidate_count int")
    good = lambda n, **kw: json.dumps({"source_id": n, "registry_id": "r", "registry_schema_version": 1, "fixed_route": f"/{n}", "enumeration_complete": True} | kw)
    stored = {"done": good("done"), "short": good("short"), "open": good("open", enumeration_complete=False), "list": "[1]", "text": "{", "moved": good("moved", fixed_route="/x"), "other": good("other", registry_id="q"), "empty": good("empty")}
    candidates = spark.createDataFrame([("done",), ("done",), ("short",), ("open",), ("list",)], "source_id string")
    got = {r["source_id"]: (r["action"], r["problem"]) for r in lifecycle.resume_plan(registry, runs, candidates, spark.createDataFrame(list(stored.items()), "source_id string, content string")).collect()}
    refuse = {"short": "finished_disagrees", "open": "finished_disagrees", "stale": "running_without_checkpoint", "list": "checkpoint_unreadable", "text": "checkpoint_unreadable", "moved": "route_changed", "other": "registry_mismatch", "lost": "finished_disagrees"}
    assert got == {n: ("refuse", refuse[n]) if n in refuse else ("collect", None) if n == "new" else ("skip", None) for n in names}


PAGES = [("a0", 200, "ok"), ("a1", 500, None), ("a2", 200, "<p>Verify <b>you</b>\n are human</p>"), ("a3", 200, "ok"), ("b0", 403, None), ("b1", 200, "ok"), ("c0", 200, "confirm you&#39;re a real <i>person</i>"), ("d0", 200, "<script>x = 1</script>fine"), ("d2", 401, None)]


def details(spark, **kw):
    rows = [(u[0], u, int(u[1]), "CAPTURED") for u, _, _ in PAGES] + [("b", "b2", 2, "DETAIL_COMPLETE"), ("d", "d1", 1, "DETAIL_COMPLETE")]
    listed = spark.createDataFrame(rows, "source_id string, detail_url string, place int, status string")
    fetched = spark.createDataFrame([(u, c, h, "") for u, c, h in PAGES], "detail_url string, http_status int, html string, error string")
    return lifecycle.read_details(listed, fetched, **kw)


def test_a_withheld_page_ends_its_source(spark):
    got = {r["detail_url"]: r["result"] for r in details(spark).collect()}
    assert got == {"a0": "read", "a1": "failed", "a2": "withheld", "a3": "unread", "b0": "withheld", "b1": "unread", "b2": "unread", "c0": "withheld", "d0": "read", "d1": "reused", "d2": "withheld"}
    lists = spark.createDataFrame([(s, s != "e") for s in "abcdef"], "source_id string, enumeration_complete boolean")
    runs = {r["source_id"]: tuple(r)[1:] for r in lifecycle.collected(details(spark), lists).collect()}
    assert runs == {"a": (4, 1, 2, "PARTIAL"), "b": (3, 0, 1, "PARTIAL"), "c": (1, 0, 1, "PARTIAL"), "d": (3, 2, 1, "PARTIAL"), "e": (0, 0, 0, "ERROR"), "f": (0, 0, 0, "EMPTY")}


def test_controlled_stop_and_resume(spark):
    got = {r["detail_url"]: r["result"] for r in details(spark, stop_after=1).collect()}
    assert {u for u, r in got.items() if r == "unread"} == {"a1", "a2", "a3", "b1", "b2", "d1", "d2"}


def test_long_walks_and_cycles(spark):
    h = "https://h.org/"
    edges = [(f"{h}{k}", f"{h}{k + 1}", False) for k in range(150)] + [(f"{h}c{k}", f"{h}c{(k + 1) % 7}", False) for k in range(7)] + [(f"{h}t", f"{h}c3", False), (f"{h}v", f"{h}c0", None)]
    links = spark.createDataFrame(edges, "page_url string, next_url string, ambiguous boolean")
    got = {r["page_url"].removeprefix(h): (r["step"], r["problem"]) for r in lifecycle.page_numbers(links, spark.createDataFrame([(h + s,) for s in ("0", "t", "v", "t")], "page_url string")).collect()}
    want = {str(k): (k, "budget" if k == 99 else None) for k in range(100)} | {"t": (0, None), "v": (0, None)}
    want |= {"c0": (1, None), "c1": (2, None), "c2": (3, "repeated page"), "c3": (1, None), "c4": (2, None), "c5": (3, None), "c6": (4, "repeated page")}
    assert got == want


def test_withheld_page_sees_text(spark):
    pages = ["<p>Checking <i>your</i> browser</p>", "<p>check quickly</p>", None, "<noscript>access denied</noscript>", "just&nbsp;a moment"]
    got = spark.createDataFrame([(k, p) for k, p in enumerate(pages)], "k int, html string").select("k", lifecycle.withheld_page("html").alias("w")).orderBy("k").collect()
    assert [r["w"] for r in got] == [True, False, False, True, True]
