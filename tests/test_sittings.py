"""Speakers by a sitting's state, against a plain reading of the rules."""

import random

from pyspark.sql import types as T

from hustings.plans import sittings

ROWS = T.StructType([T.StructField("sitting", T.StringType()), T.StructField("seq", T.LongType()), T.StructField("name", T.StringType()), T.StructField("bracket", T.StringType()), T.StructField("named", T.ArrayType(T.StringType())), T.StructField("bracketed", T.ArrayType(T.StringType())), T.StructField("hall", T.BooleanType())])


def slow(rows):
    """History as a list that is searched backwards, offices as lists."""
    out, history, offices = [], [], {}
    for sitting, seq, name, _, named, bracketed, hall in rows:
        ids, how = set(named or []), "name"
        if bracketed:
            if not ids or (len(set(bracketed)) == 1 and "speaker" in name.lower()):
                ids = set(bracketed)
            else:
                ids &= set(bracketed)
        if len(ids) > 1:
            for x in reversed(history[:-1]):
                if x in ids:
                    ids, how = {x}, "history"
                    break
            else:
                if hall and history and history[-1] in ids:
                    ids, how = {history[-1]}, "history"
        title = {"The Chairman": "The Chairman of Ways and Means"}.get(name, name)
        if not ids and offices.get(title):
            ids, how = set(offices[title]), "office"
        if bracketed:
            offices[name] = set(ids) if name == "Madam Deputy Speaker" else offices.get(name, set()) | ids
        person = min(ids) if len(ids) == 1 else None
        history.append(person)
        out.append((sitting, seq, person, how if person else "multiple" if ids else "none"))
    return out


def test_speakers_equal_the_plain_rules(spark):
    rng, works = random.Random(9), {}
    people = [f"p{i}" for i in range(6)]
    for s in ["a", "b", "c", "d", None]:
        rows = []
        for n in range(rng.randrange(5, 120)):
            kind = rng.random()
            name = rng.choice(["Mr Bee", "The Minister", "The Chairman", "The Chairman of Ways and Means", "Madam Deputy Speaker", "Mr Speaker"])
            bracketed = rng.choice([None, [], rng.sample(people, rng.choice([1, 1, 2]))])
            rows.append((s, n, name, "x" if bracketed else None, rng.choice([None, [], rng.sample(people, 1), rng.sample(people, 3)]) if kind < 0.8 else None, bracketed, rng.choice([None, s == "c"])))
        works[s] = rows
    every = [r for rows in works.values() for r in rows]
    rng.shuffle(every)
    got = sorted((tuple(r) for r in sittings.speakers(spark.createDataFrame(every, ROWS).repartition(3)).collect()), key=str)
    assert got == sorted((r for rows in works.values() for r in slow([(*x[:6], bool(x[6])) for x in rows])), key=str)


def test_an_office_is_remembered_for_its_sitting(spark):
    rows = [("d", 1, "The Minister for Industry", "Ann Bee", [], ["ann"], False), ("d", 2, "Mr Cee", None, ["cee"], None, False), ("d", 3, "The Minister for Industry", None, [], None, False), ("e", 1, "The Minister for Industry", None, None, None, False)]
    got = sorted(tuple(r) for r in sittings.speakers(spark.createDataFrame(rows, ROWS)).collect())
    assert got == [("d", 1, "ann", "name"), ("d", 2, "cee", "name"), ("d", 3, "ann", "office"), ("e", 1, None, "none")]


def test_the_query_equals_the_plain_rules(spark):
    import __spark_entry__
    import pyarrow.parquet as pq

    folder = "/root/testdata/sf0.001"
    sitting = {}
    for r in sorted(pq.read_table(f"{folder}/events.parquet").to_pylist(), key=lambda r: r["event_id"]):
        u, n, kind = r["user_id"], r["event_id"], r["event_type"]
        office = kind in ("error", "signup")
        row = (str(r["ts"])[:10], n, f"The Minister {n % 7}" if office else f"Mr {u}", None, [str(u)] if kind == "view" else [str(u + k) for k in range(3)] if kind in ("click", "purchase") else None, [str(u)] if kind == "error" else None, False)
        sitting.setdefault(row[0], []).append(row)
    got = sorted(tuple(r) for r in __spark_entry__.queries()["sitting_speakers"](spark, folder).collect())
    assert [x[:2] for x in got] == sorted(x[:2] for rows in sitting.values() for x in rows)
    assert sorted(got, key=str) == sorted((x for rows in sitting.values() for x in slow(rows)), key=str)
