"""State machines and ordered revisions, in several runs, against folds of all events at once."""

import random

from pyspark.sql import functions as F

from hustings.streaming import ingest, revisions, states

RULES = states.Rules("new", {("new", "found"): "wanted", ("wanted", "failed"): "waiting", ("wanted", "fetched"): "done", ("waiting", "failed"): "waiting", ("waiting", "fetched"): "done", ("done", "forced"): "wanted"}, {"waiting": (60, "wanted"), "wanted": (600, "stale")})
EVENTS = "item long, ts timestamp, event string, event_id long"


def test_transitions_equal_a_fold_over_restarts(spark, tmp_path):
    rng, clock, rows = random.Random(5), 1_700_000_000_000, []
    for n in range(900):
        clock += rng.randrange(1, 20_000)
        rows.append((rng.choice([*range(12), None]), clock, rng.choice(["found", "failed", "fetched", "forced", "other", None]), n))
    source, work = f"file://{tmp_path}/in", f"file://{tmp_path}/work"
    # Four runs; within one, rows lie in no order over several files.
    for k in range(4):
        part = rows[225 * k : 225 * (k + 1)]
        rng.shuffle(part)
        df = spark.createDataFrame([(i, t, e, n) for i, t, e, n in part], "item long, ms long, event string, event_id long").select("item", F.timestamp_millis("ms").alias("ts"), "event", "event_id")
        df.repartition(3).write.mode("append").parquet(source)
        moves = ingest.drain(states.transitions(states.stream_of(spark, source, df.schema), "item", "event", RULES), "append", work)
    got = {}
    for r in moves.collect():
        got.setdefault(r["item"], []).append((r["at_ms"], r["event_id"], r["was"], r["now"]))
    last = max(t for i, t, e, _ in rows if i is not None and e is not None)
    for item in range(12):
        want = states.folded([(t, n, e) for i, t, e, n in rows if i == item and e is not None], RULES, last)
        assert sorted(got.get(item, []), key=str) == sorted(want, key=str), item
    now = {r["item"]: r["state"] for r in states.current(moves, "item").collect()}
    assert now == {i: max(g, key=lambda s: (s[0], s[1] is not None, s[1] or 0))[3] for i, g in got.items()}


def test_times_are_rounded_and_events_of_one_millisecond_stay_in_order(spark, tmp_path):
    # Microseconds; in the second run the later event has the smaller id.
    runs = [[(1, 1_700_000_000_000_500, "found", 1)], [(1, 1_700_000_001_000_700, "failed", 9), (1, 1_700_000_001_000_900, "fetched", 8)]]
    source, work = f"file://{tmp_path}/in", f"file://{tmp_path}/work"
    for part in runs:
        df = spark.createDataFrame(part, "item long, us long, event string, event_id long").select("item", F.timestamp_micros("us").alias("ts"), "event", "event_id")
        df.write.mode("append").parquet(source)
        moves = ingest.drain(states.transitions(states.stream_of(spark, source, df.schema), "item", "event", RULES), "append", work)
    got = sorted((r["at_ms"], r["at_us"], r["event_id"], r["was"], r["now"]) for r in moves.collect())
    assert got == [(1_700_000_000_001, runs[0][0][1], 1, "new", "wanted"), (1_700_000_001_001, runs[1][0][1], 9, "wanted", "waiting"), (1_700_000_001_001, runs[1][1][1], 8, "waiting", "done")]
    assert [tuple(r) for r in states.current(moves, "item").collect()] == [(1, "done", 1_700_000_001_001, 3)]


def test_revisions_in_any_order_give_the_same_table(spark, tmp_path):
    rng = random.Random(3)
    rows = [(f"d{d}", n, rng.choice(["a", "b", "a longer text", "", None])) for d in range(9) for n in range(1, rng.randrange(2, 7)) if not (d == 4 and n == 2)]
    results = []
    for turn in range(3):
        rng.shuffle(rows)
        source, work = f"file://{tmp_path}/in{turn}", f"file://{tmp_path}/work{turn}"
        for k in range(0, len(rows), 7):
            df = spark.createDataFrame([*rows[k : k + 7], *rows[k : k + 1], ("odd", 0, "x"), (None, 1, "y")], "doc string, revision int, text string")
            df.write.mode("append").parquet(source)
            done = revisions.apply(states.stream_of(spark, source, df.schema), "doc", work)
        results.append(sorted((tuple(r) for r in done.collect()), key=str))
    assert results[0] == results[1] == results[2]
    want = []
    for doc in {r[0] for r in rows}:
        own = {n: t for d, n, t in rows if d == doc}
        n = 1
        while n in own:
            want.append((doc, n, own[n], "new" if n == 1 else "same" if own[n] == own[n - 1] else "change"))
            n += 1
    assert results[0] == sorted(want, key=str)


def test_first_seen_writes_what_changes(spark, tmp_path):
    source, work = f"file://{tmp_path}/in", f"file://{tmp_path}/work"
    for part in ([("a", 5), ("b", 2), (None, 9)], [("a", 3), ("b", 4), ("c", 7)], [("a", 8), (None, 1)]):
        df = spark.createDataFrame(part, "k string, id long")
        df.coalesce(1).write.mode("append").parquet(source)
        found = ingest.first_seen(states.stream_of(spark, source, df.schema), ["k"], "id", work)
    assert sorted((tuple(r) for r in found.collect()), key=str) == sorted([("a", 3), ("b", 2), ("c", 7), (None, 1)], key=str)
    last = spark.read.parquet(f"{work}/held-2").collect()
    assert [tuple(r) for r in last] == [(None, 1)]


def test_texts_of_revisions_are_shuffled_once(spark, tmp_path):
    source, work = f"file://{tmp_path}/in", f"file://{tmp_path}/work"
    for part in ([("d", 2, "b"), ("d", 2, "c"), ("e", 1, None)], [("d", 1, "a"), ("d", 2, "later"), ("e", 2, None), ("e", 4, "z")], [("d", 3, "x"), ("e", 2, "late")]):
        df = spark.createDataFrame(part, "doc string, revision int, text string")
        df.coalesce(1).write.mode("append").parquet(source)
        done = revisions.apply(states.stream_of(spark, source, df.schema), "doc", work)
    least = min(("b", "c"), key=lambda x: spark.range(1).select(F.xxhash64(F.lit(x))).first()[0])
    want = [("d", 1, "a", "new"), ("d", 2, least, "change"), ("d", 3, "x", "change"), ("e", 1, None, "new"), ("e", 2, None, "same")]
    assert sorted(tuple(r) for r in done.collect()) == want
    assert sorted(tuple(r) for r in revisions.current(done, "doc").collect()) == [("d", 3, "x"), ("e", 1, None)]
    plan = revisions.current(done, "doc")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    # What tells of applied revisions holds no texts.
    assert "text" not in spark.read.parquet(f"{work}/applied-0").columns
