"""Streams take files in once and agree with batches."""

from hustings.sources.shared import with_checkpoints
from hustings.streaming import ingest


def test_second_run_takes_only_new_files(spark, tmp_path):
    def add(n, ids):
        spark.createDataFrame([(i,) for i in ids], "event_id long").coalesce(1).write.parquet(str(tmp_path / f"in/{n}"))

    seen = []
    sink = lambda batch, number: seen.append(sorted(r.event_id for r in batch.collect()))
    start = lambda: ingest.run(spark.readStream.schema("event_id long").parquet(str(tmp_path / "in/*")), sink, str(tmp_path / "state"))
    add(1, [1, 2])
    start()
    add(2, [3])
    start()
    start()
    assert seen == [[1, 2], [3]]


def test_new_files(spark, tmp_path):
    with_checkpoints(spark)
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text("a")
    names = lambda fresh: sorted(r.path.rsplit("/", 1)[1] for r in fresh.collect())
    once = lambda: ingest.new_files(spark, str(tmp_path / "in"), str(tmp_path / "seen"), names)
    assert once() == ["a.txt"] and once() is None
    (tmp_path / "in/b.txt").write_text("b")
    assert once() == ["b.txt"]


def test_repeats_within_the_watermark_go(spark, tmp_path):
    import datetime

    rows = [(1, datetime.datetime(2024, 1, 1)), (1, datetime.datetime(2024, 1, 2)), (2, datetime.datetime(2024, 1, 2))]
    spark.createDataFrame(rows, "event_id long, ts timestamp").coalesce(1).write.parquet(str(tmp_path / "in"))
    got = ingest.drain(ingest.without_repeats(ingest.file_stream(spark, str(tmp_path / "in")), ["event_id"]))
    assert sorted(r.event_id for r in got.collect()) == [1, 2]


def test_sessions_keep_events_of_later_batches(spark, tmp_path):
    import datetime
    import os

    days = [[datetime.datetime(2024, 6, 1), datetime.datetime(2024, 6, 1, 1)], [datetime.datetime(2024, 1, 1), datetime.datetime(2024, 5, 20)], [datetime.datetime(2023, 1, 1)]]
    os.mkdir(tmp_path / "in")
    for n, ts in enumerate(days):
        spark.createDataFrame([(7, t) for t in ts], "user_id long, ts timestamp").coalesce(1).write.parquet(str(tmp_path / f"part{n}"))
        name = next((tmp_path / f"part{n}").glob("*.parquet"))
        os.rename(name, tmp_path / f"in/{n}.parquet")
        os.utime(tmp_path / f"in/{n}.parquet", (1_700_000_000 + 100 * n,) * 2)
    got = ingest.drain(ingest.sessions(ingest.file_stream(spark, str(tmp_path / "in"), per_batch=1)), "complete")
    assert sorted((r.started[:10], r.n) for r in got.collect()) == [("2023-01-01", 1), ("2024-01-01", 1), ("2024-05-20", 1), ("2024-06-01", 2)]


def test_states_outlive_a_run(spark, tmp_path):
    events = lambda ids: spark.createDataFrame([(i, i % 2, "error" if i % 3 == 0 else "view") for i in ids], "event_id long, user_id long, event_type string")
    path, state, seen = (str(tmp_path / n) for n in ("events", "state", "seen"))
    for ids, want in ((range(6), {0: (3, 1, 4), 1: (3, 1, 5)}), (range(6, 8), {0: (4, 2, 6), 1: (4, 1, 7)})):
        events(ids).write.mode("append").parquet(path)
        got = ingest.user_states(ingest.file_stream(spark, path, 1), f"file://{state}")
        assert {r.user_id: (r.n, r.n_errors, r.last_event) for r in got.collect()} == want
        first = ingest.first_seen(ingest.file_stream(spark, path, 1), ["user_id"], "event_id", f"file://{seen}")
        assert sorted(map(tuple, first.collect())) == [(0, 0), (1, 1)]
