"""Upkeep of people on hand-made tables."""

import datetime

import pytest
from pyspark.sql import functions as F

from hustings.__main__ import main
from hustings.plans import people
from hustings.sources.shared import with_checkpoints

MEMBERSHIP = "id long, person_id string, organization_id string, area string, party string, start_date date, end_date date, start_reason string, end_reason string"


def d(s):
    return datetime.date.fromisoformat(s)


@pytest.fixture
def memberships(spark):
    with_checkpoints(spark)
    rows = [(1, "p1", "commons", "Ely", "A", d("1997-05-01"), d("2001-05-14"), None, None), (2, "p1", "commons", "Ely", "A", d("2001-06-07"), None, None, None), (3, "p2", "commons", "Hull", "B", d("1997-05-01"), None, None, None), (4, "p3", "lords", None, "B", d("1990-01-01"), None, None, None)]
    return spark.createDataFrame(rows, MEMBERSHIP)


def test_ends(memberships):
    got = people.end_memberships(memberships, F.col("organization_id") == "commons", "2005-04-11", "dissolution")
    assert {r.id: (str(r.end_date), r.end_reason) for r in got.collect()} == {1: ("2001-05-14", None), 2: ("2005-04-11", "dissolution"), 3: ("2005-04-11", "dissolution"), 4: ("None", None)}


def test_party_change_and_chains(spark, memberships):
    changes = spark.createDataFrame([("p1", "C", d("2003-01-01")), ("p2", "B", d("2003-01-01"))], "person_id string, party string, day date")
    got = people.change_party(memberships, changes)
    rows = {r.id: r for r in got.collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5] and rows[2].end_date == d("2002-12-31") and rows[2].end_reason == "changed_party"
    assert (rows[5].party, rows[5].start_date, rows[5].end_date, rows[5].area) == ("C", d("2003-01-01"), None, "Ely") and rows[3].end_date is None
    chains = {(r.person_id, str(r.start_date)): list(r.parties) for r in people.party_chains(got).collect()}
    assert chains[("p1", "2001-06-07")] == ["A", "C"] and chains[("p1", "1997-05-01")] == ["A"]


def test_merges(spark, memberships):
    persons = spark.createDataFrame([("p1", ["Ann"], ["x1"]), ("p2", ["Anne"], ["x2"]), ("p3", ["Cy"], [])], "id string, names array<string>, identifiers array<string>")
    merges = spark.createDataFrame([("p2", "p1")], "source string, target string")
    kept, terms = people.merge_people(persons, memberships, merges)
    assert {r.id: (r.redirect, r.names) for r in kept.collect()} == {"p1": (None, ["Ann", "Anne"]), "p2": ("p1", None), "p3": (None, ["Cy"])}
    assert {r.id: r.person_id for r in terms.collect()} == {1: "p1", 2: "p1", 3: "p1", 4: "p3"}


def test_names_on_a_day(spark):
    names = spark.createDataFrame([("p1", "Main", "Ann", "Maiden", None, None, None, None, d("1999-06-30")), ("p1", "Main", "Ann", "Married", None, None, None, d("1999-07-01"), None), ("p2", "Main", None, None, "Baroness", "Smith", "Leeds", None, None), ("p3", "Alternate", "X", "Y", None, None, None, None, None)], "person_id string, note string, given_name string, family_name string, honorific_prefix string, lordname string, lordofname string, start_date date, end_date date")
    assert {r.person_id: r.shown for r in people.name_on(names, "2000-01-01").collect()} == {"p1": "Ann Married", "p2": "Baroness Smith of Leeds"}


def test_checks(spark, memberships):
    seats = spark.createDataFrame([("commons", 1), ("lords", 5)], "organization_id string, seats int")
    assert [r.organization_id for r in people.over_full(memberships, seats).collect()] == ["commons"]
    posts = spark.createDataFrame([("Ely", d("1990-01-01"), None), ("Hull", d("2000-01-01"), None)], "area string, start_date date, end_date date")
    assert sorted(r.id for r in people.misplaced(memberships, posts).collect()) == [3, 4]
    ours, theirs = spark.createDataFrame([("p1", "Lab"), ("p2", "Con")], "person_id string, party string"), spark.createDataFrame([("p1", "Labour"), ("p2", "LD")], "person_id string, party string")
    assert [r.person_id for r in people.party_disagreements(ours, theirs, {"Lab": "Labour"}).collect()] == ["p2"]


def test_profiles_committees_and_history(spark):
    ids = spark.createDataFrame([("p1", "pims", "7"), ("p1", "mnis", "8"), ("p2", "mnis", "9")], "person_id string, scheme string, identifier string")
    assert sorted(map(tuple, people.profile_urls(ids, {"mnis": "https://m/{}", "pims": "https://p/{}/x"}).collect())) == [("p1", "https://m/8", "https://p/7/x"), ("p2", "https://m/9", None)]
    rows = spark.createDataFrame([("Home Affairs", "Ann", "Chair", "p1"), ("Home Affairs", "Bob", None, None)], "committee string, person string, role string, person_id string")
    assert tuple(people.committees(rows).first()) == ("home-affairs", "Home Affairs", ["Ann"], ["Ann", "Bob"], 1)
    who = spark.createDataFrame([("p1", "Ann", 1919, 1922), ("p2", "Bob", 1919, 1922), ("p3", "Bob", 1919, 1922)], "person_id string, name string, first_year int, last_year int")
    urls = spark.createDataFrame([("Ann", 1919, 1922, "u1"), ("Bob", 1919, 1922, "u2")], "name string, first_year int, last_year int, url string")
    assert [tuple(r) for r in people.historic_matches(who, urls).collect()] == [("p1", "u1")]


def test_command_line(spark, tmp_path, capsys):
    main(["list"])
    assert "interval_join" in capsys.readouterr().out
    main(["run", "broadcast_lookup", "/root/testdata/sf0.001", str(tmp_path / "out")])
    assert spark.read.parquet(str(tmp_path / "out")).count() == 20
