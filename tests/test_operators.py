"""Operators on hand-made and random tables."""

import datetime
import random

from pyspark.sql import functions as F

from hustings.operators import sequences, tables, temporal


def day(n):
    return datetime.date(2020, 1, 1) + datetime.timedelta(n)


def test_pad_dates(spark):
    df = spark.createDataFrame([("1997",), ("1997-02",), ("1997-05-01",), (None,), ("0000-00-00",), ("bad",)], "s string")
    got = df.select(temporal.pad_date(F.col("s")).cast("string").alias("a"), temporal.pad_date(F.col("s"), end=True).cast("string").alias("b")).collect()
    assert [tuple(r) for r in got] == [("1997-01-01", "1997-12-31"), ("1997-02-01", "1997-02-28"), ("1997-05-01", "1997-05-01"), ("0001-01-01", "9999-12-31"), ("0001-01-01", "9999-12-31"), (None, None)]


def test_containment_counts_containers(spark):
    inner = spark.createDataFrame([("a", 1, day(1), day(5)), ("a", 2, day(1), day(50)), ("b", 3, day(1), day(2))], "k string, id int, s date, e date")
    outer = spark.createDataFrame([("a", day(0), day(9)), ("a", day(0), day(5))], "k string, os date, oe date")
    assert {r.id: r.n_containers for r in temporal.containment(inner, outer, "k", "s", "e", "os", "oe").collect()} == {1: 2, 2: 0, 3: 0}


def test_as_of_skips_the_row_before(spark):
    rows = [(1, "x"), (3, "y"), (5, "z")]
    right = spark.createDataFrame([("k", at, at, v) for at, v in rows], "k string, t int, i int, v string")
    left = spark.createDataFrame([("k", 4, 100), ("k", 6, 101), ("k", 1, 102)], "k string, t int, i int")
    assert {r.i: r.latest_v for r in temporal.as_of(left, right, ["k"], "t", ["i"], "v").collect()} == {100: "y", 101: "z", 102: "x"}
    assert {r.i: r.latest_v for r in temporal.as_of(left, right, ["k"], "t", ["i"], "v", skip=1).collect()} == {100: "x", 101: "y", 102: None}


def test_chunked_sequences_equal_whole_ones(spark):
    rng = random.Random(4)
    rows = [(f"k{rng.randrange(3)}", i, rng.choice([None, i]), i // 7) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, i int, v int, c int")
    for make in (lambda c: sequences.carry_forward(df, ["k"], ["i"], F.col("v"), "x", c), lambda c: sequences.running_count(df, ["k"], ["i"], F.col("v").isNotNull(), "x", c)):
        assert sorted((r.i, r.x) for r in make(None).collect()) == sorted((r.i, r.x) for r in make(F.col("c")).collect())


def test_merge_adjacent_pairs(spark):
    rows = [(1, "h", "A"), (2, "h", "B"), (3, "h", "C"), (4, "t", "x"), (5, "h", "D")]
    df = spark.createDataFrame([("k", *r) for r in rows], "k string, i int, kind string, text string")
    assert [r.merged for r in sequences.merge_adjacent(df, ["k"], ["i"], "kind", "text").orderBy("i").collect()] == ["A B", "C", "x", "D"]


def test_global_rank_is_whole(spark):
    values = list(range(500))
    random.Random(1).shuffle(values)
    from hustings.sources.shared import with_checkpoints

    with_checkpoints(spark)
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(7)
    assert {r.v: r.place for r in sequences.global_rank(df, [F.desc("v")]).collect()} == {v: 500 - v for v in values}


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "id int, v string")
    once = tables.upsert(old, new, ["id"])
    assert sorted(map(tuple, tables.upsert(once, new, ["id"]).collect())) == sorted(map(tuple, once.collect())) == [(1, "a"), (2, "c"), (3, "d")]
    assert {r.id: r.action for r in tables.merge_actions(old, new, "id", ["v"]).collect()} == {1: "rescinded", 2: "update", 3: "insert"}


def test_redirects_follow_chains_and_survive_loops(spark):
    from hustings.sources.shared import with_checkpoints

    with_checkpoints(spark)
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100)]
    got = tables.redirected(spark.createDataFrame([(i,) for i in (0, 17, 40, 55, 100)], "p int"), spark.createDataFrame(chain, "source int, target int"), "p").collect()
    assert sorted(r.p for r in got)[:4] == [40, 40, 40, 55] and len(got) == 5


def test_cascade_prefers_earlier_rules(spark):
    probes = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, k string")
    one = spark.createDataFrame([("a", 10)], "k1 string, found int")
    two = spark.createDataFrame([("a", 20), ("b", 21), ("b", 22)], "k2 string, found int")
    found = tables.cascade(probes, "id", [(one, F.col("k") == F.col("k1")), (two, F.col("k") == F.col("k2"))], "found")
    assert {(r.id, r.status, r.match) for r in tables.match_status(probes, found, "id", "found").collect()} == {(1, "match", 10), (2, "multiple", None), (3, "none", None)}


def test_arrays_and_versions(spark):
    r = spark.range(1).select(tables.append_missing(F.array(F.lit(1), F.lit(2)), F.array(F.lit(2), F.lit(3))).alias("a"), tables.version_class(F.lit("ab"), F.lit("abc")).alias("b"), tables.version_class(F.lit("ab"), F.lit("xb")).alias("c")).first()
    assert (list(r.a), r.b, r.c) == ([1, 2, 3], "EXTENSION", "DIFFERENT")


def test_carved_pieces_cover_the_post(spark):
    post = spark.createDataFrame([("a", day(0), day(20)), ("b", day(0), day(3))], "k string, start_date date, end_date date")
    inner = spark.createDataFrame([("a", day(5), day(9)), ("a", day(18), day(40))], "k string, start_date date, end_date date")
    got = sorted((r.k, (r.start_date - day(0)).days, (r.end_date - day(0)).days, r.inside) for r in temporal.carve(post, inner, "k").collect())
    assert got == [("a", 0, 4, False), ("a", 5, 9, True), ("a", 10, 17, False), ("a", 18, 20, True), ("b", 0, 3, False)]
    assert temporal.carve(post, inner.limit(0), "k").count() == 2


def test_positional_pairs(spark):
    a, b = spark.createDataFrame([("k", 1), ("k", 2)], "k string, x int"), spark.createDataFrame([("k", 5)], "k string, x int")
    assert tables.positional(a, b.withColumnRenamed("x", "y").withColumn("x", F.col("y")), ["k"], "x").count() == 2


def test_overlaps_and_carving_equal_all_pairs(spark):
    import random

    rng = random.Random(12)
    rows = [(rng.choice("abc"), n, *rng.choice([(s, s + rng.randrange(-2, 9)), (s, None), (None, s)])) for n in range(120) for s in [rng.randrange(200)]]
    df = spark.createDataFrame([(k, n, s, e) for k, n, s, e in rows], "k string, n int, s int, e int").repartition(3)
    got = sorted(tuple(r) for r in temporal.overlap_conflicts(df, ["k"], "s", "e", "n").collect())
    full = [r for r in rows if r[2] is not None and r[3] is not None]
    assert got == sorted((a[0], a[1], b[1]) for a in full for b in full if a[0] == b[0] and a[1] < b[1] and a[2] <= b[3] and b[2] <= a[3])

    day = lambda n: datetime.date(2020, 1, 1) + datetime.timedelta(n)
    posts = {(k, s, s + rng.randrange(40)) for k in "abc" for s in (rng.randrange(150) for _ in range(4))}
    inner = [(rng.choice("abd"), s, s + rng.randrange(8)) for s in (rng.randrange(200) for _ in range(25))]
    frame = lambda rs: spark.createDataFrame([(k, day(s), day(e)) for k, s, e in rs], "k string, start_date date, end_date date")
    held = {(k, d) for k, s, e in inner for d in range(s, e + 1)}
    covered = sorted((r["k"], d, r["inside"]) for r in temporal.carve(frame(sorted(posts)), frame(inner), "k").collect() for d in range((r["start_date"] - day(0)).days, (r["end_date"] - day(0)).days + 1))
    assert covered == sorted((k, d, (k, d) in held) for k, s, e in posts for d in range(s, e + 1))


def test_candidates_that_all_clues_agree_on_take_one_pass(spark):
    clue = lambda rows: spark.createDataFrame(rows, "id int, found string")
    one, two = clue([(1, "a"), (1, "b"), (1, "b"), (2, "a"), (4, None)]), clue([(1, "b"), (1, "c"), (3, "z"), (4, None), (4, "y")])
    both = tables.candidate_intersection([one, two], "id", "found")
    assert sorted(map(tuple, both.collect()), key=str) == [(1, "b"), (2, "a"), (3, "z"), (4, None)]
    # Each clue is read once.
    assert both._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 2
