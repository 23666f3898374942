"""Resolution, transcripts, registers, alignment and links on hand-made records."""

import datetime
import random

from pyspark.sql import functions as F

from hustings.plans import alignment, linking, registers, resolution, transcripts


def d(s):
    return datetime.date.fromisoformat(s)


def test_resolution_rules(spark):
    terms = [("p1", "Ann Other", "Leeds East", d("1997-05-01"), d("2001-05-14")), ("p2", "Bob Other", "Ely", d("1997-05-01"), d("2005-04-11")), ("p3", "Ann Other", "Hull", d("2001-06-07"), d("2005-04-11")), ("p4", "Cy Long", "Bath", d("1997-05-01"), d("9999-12-31"))]
    alias = resolution.aliases(spark.createDataFrame(terms, "person string, name string, seat string, start_date date, end_date date"))
    probes = [(1, "Mr. Ann Other", None, d("2000-01-01")), (2, "Ann Other", None, None), (3, "Ann Other", "Hull", None), (4, "Mr Other", None, d("2000-01-01")), (5, "Other", None, d("2000-01-01")), (6, "Dr Long", None, d("2010-01-01")), (7, None, "Ely", d("2000-01-01")), (8, "Nobody", None, None)]
    got = {r.id: (r.status, r.match) for r in resolution.resolve(spark.createDataFrame(probes, "id int, name string, seat string, day date"), alias, "id").collect()}
    assert got == {1: ("match", "p1"), 2: ("multiple", None), 3: ("match", "p3"), 4: ("multiple", None), 5: ("none", None), 6: ("match", "p4"), 7: ("match", "p2"), 8: ("none", None)}


def test_names_offices_and_identifiers(spark):
    names = spark.createDataFrame([("p1", "Ann Maiden", d("1997-01-01"), d("1999-06-30")), ("p1", "Ann Married", d("1999-07-01"), d("9999-12-31"))], "person string, name string, name_start date, name_end date")
    terms = spark.createDataFrame([("p1", "Ely", d("1997-05-01"), d("2001-05-14"))], "person string, seat string, start_date date, end_date date")
    assert sorted((r.name, str(r.start_date), str(r.end_date)) for r in resolution.name_ranges(names, terms).collect()) == [("Ann Maiden", "1997-05-01", "1999-06-30"), ("Ann Married", "1999-07-01", "2001-05-14")]
    offices = spark.createDataFrame([("Speaker", "p1", d("1997-01-01"), d("1999-01-01")), ("Clerk", "p2", d("1997-01-01"), None)], "title string, person string, start_date date, end_date date")
    probes = spark.createDataFrame([(1, "speaker", d("1998-12-31")), (2, "Speaker", d("1999-01-01")), (3, "Clerk", d("1998-01-01")), (4, "Clerk", None)], "id int, office string, day date")
    assert {r.id: r.status for r in resolution.office_holders(probes, offices, "id").collect()} == {1: "match", 2: "none", 3: "none", 4: "match"}
    ids = spark.createDataFrame([("pims", "77", "p1")], "scheme string, identifier string, person string")
    asked = spark.createDataFrame([(1, "pims", "77", d("1998-01-01")), (2, "pims", "77", d("2010-01-01"))], "id int, scheme string, identifier string, day date")
    assert {r.id: r.match for r in resolution.by_identifier(asked, ids, terms, "id").collect()} == {1: "p1", 2: None}


def test_office_holders_are_counted_without_pairs(spark):
    rng = random.Random(4)
    day = lambda n: None if n is None else datetime.date(2000, 1, 1) + datetime.timedelta(days=n)
    held = []
    for _ in range(120):
        start = rng.choice([None, *range(60)])
        held.append((rng.choice(["The Clerk", "the clerk ", "Whip", None]), rng.choice(["p1", "p2", "p3", None]), start, None if rng.random() < 0.2 else (start or 0) + rng.randrange(-1, 9)))
    asked = [(n, rng.choice(["The Clerk", "Whip", "Nobody", None]), rng.choice([None, *range(-2, 70)])) for n in range(300)]
    offices = spark.createDataFrame([(t, p, day(a), day(b)) for t, p, a, b in held], "title string, person string, start_date date, end_date date")
    found = resolution.office_holders(spark.createDataFrame([(n, o, day(x)) for n, o, x in asked], "id int, office string, day date"), offices, "id")
    got = {r.id: (r.n_candidates, r.status, r.match) for r in found.collect()}
    for n, office, x in asked:
        people = {p for t, p, a, b in held if p and t and office and t.strip().lower() == office.lower() and (x is None or (None not in (a, b) and a <= x < b))}
        assert got[n] == (len(people), ["none", "match", "multiple"][min(2, len(people))], min(people) if len(people) == 1 else None), (n, office, x)


def test_history_settles_ambiguous_speakers(spark):
    speeches = spark.createDataFrame([("s", 1, "a"), ("s", 2, "b"), ("s", 3, None), ("s", 4, "c"), ("s", 5, None)], "sitting string, seq int, person string")
    found = spark.createDataFrame([("s", 3, "a"), ("s", 3, "b"), ("s", 5, "x"), ("s", 5, "y")], "sitting string, seq int, person string")
    assert [(r.seq, r.person, r.source) for r in resolution.by_history(speeches, found).orderBy("seq").collect()] == [(1, "a", "given"), (2, "b", "given"), (3, "a", "history"), (4, "c", "given"), (5, None, "unknown")]


def test_components(spark):
    rows = ["time|10.30 am", "heading|Big", "heading|Part", "speaker|Ann Other:", "text|Hello", "quote|Hear", "time|11.00 am", "subheading|Small", "text|Nobody", "heading|Next", "speaker|Bob", "text|Bye"]
    df = spark.createDataFrame([("s1", d("2024-03-05"), i, *r.split("|")) for i, r in enumerate(rows)], "sitting string, day date, seq int, kind string, text string")
    got = [(r.gid, r.speaker, r.time, r.text) for r in transcripts.from_components(df, "ni/").orderBy("seq").collect()]
    assert got == [("ni/2024-03-05.1.0", None, "10:30:00", "Big Part"), ("ni/2024-03-05.1.1", "Ann Other", "10:30:00", "Hello"), ("ni/2024-03-05.1.2", "Ann Other", "10:30:00", "Hear"), ("ni/2024-03-05.1.3", None, "11:00:00", "Small"), ("ni/2024-03-05.1.4", None, "11:00:00", "Nobody"), ("ni/2024-03-05.2.0", None, "11:00:00", "Next"), ("ni/2024-03-05.2.1", "Bob", "11:00:00", "Bye")]


def test_xml_day(spark):
    xml = "<day><column n='5'/><heading>One</heading><time>2.30 pm</time><speech name='Ann' office='Chair'><p>A <i>b</i></p><p>c</p></speech><column n='6'/><speech name='Bob'>d</speech></day>"
    rows = transcripts.from_xml(spark.createDataFrame([(d("2024-03-05"), "a", xml)], "day date, revision string, xml string"), "debate/")
    got = [(r.gid, r.kind, r.name, r.office, r.heading, r.time, list(r.paras)) for r in rows.orderBy("seq").collect()]
    assert got == [("debate/2024-03-05a.5.0", "heading", None, None, "One", None, ["One"]), ("debate/2024-03-05a.5.1", "speech", "Ann", "Chair", "One", "14:30:00", ["A b", "c"]), ("debate/2024-03-05a.6.0", "speech", "Bob", None, "One", "14:30:00", ["d"])]
    assert sorted(r.pid for r in transcripts.paragraph_ids(rows).collect())[-3:] == ["debate/2024-03-05a.5.1/1", "debate/2024-03-05a.5.1/2", "debate/2024-03-05a.6.0/1"]


def test_report_pages(spark):
    html = "<p>Opening</p><p><strong>Ann Other (Chair):</strong> Hello</p><p>more</p><strong>Bob:</strong> Yes"
    got = [(r.turn, r.speaker, r.office, r.text) for r in transcripts.from_report(spark.createDataFrame([(1, html)], "page_id int, html string")).orderBy("turn").collect()]
    assert got == [(0, None, None, "Opening"), (1, "Ann Other", "Chair", "Hello\nmore"), (2, "Bob", None, "Yes")]


def test_divisions(spark):
    lists = spark.createDataFrame([(1, "aye", ["Other, Ann (Leeds) (Lab)", "Long, Cy (Proxy vote cast by Bob Other)"]), (1, "no", ["Bob Other (Con)", "Short, Di Teller"])], "division_id int, vote string, lines array<string>")
    votes = transcripts.divisions(lists)
    got = {r.family: (r.given, r.party, r.teller, r.proxy) for r in votes.collect()}
    assert got == {"Other": ("Bob", "Con", False, None), "Long": ("Cy", None, False, "Bob Other"), "Short": ("Di", None, True, None)} or got["Long"] == ("Cy", None, False, "Bob Other")
    assert tuple(transcripts.tallies(votes).first()) == (1, 2, 1, 0, "agreed")


def test_written_answers(spark):
    items = [(12, d("2024-03-05"), "Health", 7, "Q12", "A"), (10, d("2024-03-05"), "Health", 7, "Q10", "A"), (30, d("2024-03-05"), "Home", None, "Q30", "B"), (30, d("2024-03-09"), "Home", None, "Q30 corrected", "B2")]
    got = sorted((r.gid, r.text) for r in transcripts.written_answers(spark.createDataFrame(items, "uin long, day date, department string, group long, question string, answer string")).collect())
    assert got == [("2024-03-05.10.h", "Health"), ("2024-03-05.10.q0", "Q10"), ("2024-03-05.10.q1", "Q12"), ("2024-03-05.10.r0", "A"), ("2024-03-05.30.h", "Home"), ("2024-03-05.30.q0", "Q30"), ("2024-03-05.30.r0", "B")]


def test_bilingual_and_stretches(spark):
    c = spark.createDataFrame([(1, 1, "hello", None), (2, 2, "yes", "ie")], "id int, seq int, text_en string, text_cy string")
    votes = spark.createDataFrame([(2, "aye"), (2, "no")], "contribution_id int, vote string")
    assert sorted((r.id, r.lang, r.text, r.n_votes) for r in transcripts.bilingual(c, votes).collect()) == [(1, "cy", "hello", 0), (1, "en", "hello", 0), (2, "cy", "ie", 2), (2, "en", "yes", 2)]
    marks = spark.createDataFrame([("s", 1, "10:00:00", "a", "one two three four"), ("s", 2, "10:02:00", "a", "five"), ("s", 3, "10:02:00", "b", "six"), ("s", 4, "10:05:00", "b", "x")], "sitting string, seq int, time string, speaker string, text string")
    assert [tuple(r) for r in transcripts.stretches(marks).collect()] == [("a", 2, 4, 2.0)]


def test_registers(spark):
    entries = spark.createDataFrame([("p1", "1", "10", "Acme & Co", 5), ("p1", "1", "11", "Beta", None), ("p2", "2", "12", None, 7)], "person_id string, category string, interest_id string, donor string, amount int")
    detailed = registers.details(entries, ["person_id", "category", "interest_id"], ["donor", "amount"])
    documents = registers.nested(detailed)
    assert {r.person_id: len(r.categories[0].entries) for r in documents.collect()} == {"p1": 2, "p2": 1}
    assert sorted((r.interest_id, r.slug, r.value, r.type) for r in registers.flattened(documents).collect()) == [("10", "amount", "5", "int"), ("10", "donor", "Acme & Co", "string"), ("11", "donor", "Beta", "string"), ("12", "amount", "7", "int")]
    assert "Acme &amp; Co" in registers.to_html(documents).filter("person_id = 'p1'").first().html
    interests = spark.createDataFrame([("1", "p", "a", None), ("2", "p", "a", "1"), ("3", "p", "a", "1"), ("4", "p", "b", "99")], "interest_id string, person_id string, category string, parent_id string")
    assert {r.interest_id: (list(r.children), r.orphaned) for r in registers.with_parents(interests).collect()} == {"1": (["2", "3"], False), "4": ([], True)}
    assert sorted(r.interest_id for r in registers.without_repeats(interests, ["person_id", "category", "parent_id"]).collect()) == ["1", "3", "4"]
    dated = spark.createDataFrame([("x", d("2020-01-01"), None), ("y", d("2021-06-01"), None), ("z", d("2018-01-01"), d("2018-06-01"))], "id string, registered date, ended date")
    days = spark.createDataFrame([(d("2020-06-01"),), (d("2021-07-01"),)], "published date")
    assert sorted((str(r.published), r.id, r.is_latest) for r in registers.snapshots(dated, days).collect()) == [("2020-06-01", "x", False), ("2021-07-01", "x", True), ("2021-07-01", "y", True)]
    motions = spark.createDataFrame([(1, "T", 5, [(5, 1, None), (6, 2, None), (7, 3, True)])], "id int, title string, primary_sponsor int, sponsors array<struct<member_id: int, order: int, withdrawn: boolean>>")
    heads, signatures = registers.proposals(motions)
    assert heads.first().n_signatures == 2 and [(r.member_id, r.is_primary, r.withdrawn) for r in signatures.orderBy("order").collect()] == [(5, True, False), (6, False, False), (7, False, True)]
    post = "array<struct<title: string, start_date: date, end_date: date>>"
    members = spark.createDataFrame([("p1", [("Minister", d("2020-01-01"), None)], None, None, [("Chair", d("2019-01-01"), None), ("Chair", d("2021-01-01"), None)])], f"person_id string, government {post}, opposition {post}, parliamentary {post}, committee {post}")
    assert [(r.kind, r.title, r.occurrence) for r in registers.positions(members).orderBy("place").collect()] == [("government", "Minister", 1), ("committee", "Chair", 1), ("committee", "Chair", 2)]


def test_alignment(spark):
    old = "alpha beta gamma delta epsilon\nsecond paragraph of the old text stays\nthird one here now"
    new = "second paragraph of the old text stays\nalpha beta gamma delta zeta\nwholly new words come in"
    got = [(r.seq, r.kind, r.target) for r in alignment.redirects(spark.createDataFrame([("w", 1, old), ("w", 2, new)], "work string, version int, text string"), "work", "version", "text").orderBy("seq").collect()]
    assert got == [(0, "perfectmatch", 1), (1, "changes", 0), (2, "missing", None)]


def test_alignment_across_put_in_paragraphs(spark):
    old = "opening words that stay\nalpha beta gamma delta epsilon\nmiddle words that stay\none two three four five\nclosing words"
    new = "opening words that stay\nput in a\nput in b\nput in c\nput in d\nalpha beta gamma delta zeta\nmiddle words that stay\none two three four six\nclosing words"
    got = {r.seq: (r.kind, r.target) for r in alignment.redirects(spark.createDataFrame([("w", 1, old), ("w", 2, new)], "work string, version int, text string"), "work", "version", "text").collect()}
    assert got[5] == ("changes", 1) and got[7] == ("changes", 3) and {got[i][0] for i in (1, 2, 3, 4)} == {"missing"}


def test_links(spark):
    found = spark.createDataFrame([(1, 0, "Housing Act", d("2024-01-01")), (1, 1, "Ann Other", d("2024-01-01")), (1, 2, "Housing Act", d("2024-01-01")), (1, 3, "Abc", d("2024-01-01")), (1, 4, "Mercury Rising", d("2024-01-01"))], "doc int, place int, phrase string, day date")
    titles = spark.createDataFrame([("Housing_Act", "Housing_Act_1980", False), ("Ann_Other", "Ann_Other", False), ("Mercury_Rising", "Mercury", True)], "requested string, final string, ambiguous boolean")
    people = spark.createDataFrame([("Ann Other", d("2020-01-01"), d("9999-12-31"))], "name string, start_date date, end_date date")
    linked = linking.link(found, titles, "doc", people)
    assert {r.place: (r.title, r.reason) for r in linked.collect()} == {0: ("Housing_Act_1980", None), 1: ("Ann_Other", "person"), 2: ("Housing_Act_1980", "repeated"), 3: (None, "no page"), 4: ("Mercury", "ambiguous")}
    assert linking.allow_list(linked).count() == 0
    props = spark.createDataFrame([(1, "description", "x"), (1, "disambiguation", "y")], "key int, name string, value string")
    pages = spark.createDataFrame([(1,), (2,)], "key int")
    assert linking.page_properties(pages, props, "key", ["description"]).count() == 1 and linking.page_properties(pages, props, "key", ["description"], keep_bare=True).count() == 2
    assert [r.phrase for r in linking.mentions(spark.createDataFrame([(1, "the House of Lords met Ann Other")], "doc int, text string"), "doc", "text").collect()] == ["House of Lords", "Ann Other"]
    assert F.lit(1) is not None


def test_marks_inside_speeches_count_from_the_next_one_on(spark):
    from hustings.plans import proceedings

    xml = (
        "<ns:System><hs_6bDepartment>Health &amp; Care</hs_6bDepartment><hs_Timeline>2.30 pm</hs_Timeline>"
        "<hs_Para><Member><B>Ann Other:</B></Member> One<?notus-xml column=12?> two &lt;3&gt;.</hs_Para><hs_brev>Indented</hs_brev>"
        "<hs_8Question>Beds</hs_8Question><hs_Para>No member here.</hs_Para><hs_Para><Member><B>Bo Else:</B></Member> Yes.</hs_Para><hs_Odd>x</hs_Odd></ns:System>"
    )
    docs = spark.createDataFrame([("2024-01-02", "a", xml), ("2024-01-03", "a", "")], "day string, revision string, xml string")
    rows = proceedings.day_rows(docs, ["day", "revision"], "p/").orderBy("seq").collect()
    assert [(r.gid, r.kind, r.speaker, r.column, r.time, r.heading, r.text) for r in rows] == [
        ("p/2024-01-02a.0.0", "major-heading", None, None, None, "Health & Care", "Health & Care"),
        ("p/2024-01-02a.0.1", "speech", "Ann Other", None, "14:30:00", "Health & Care", "One two <3>.\n\tIndented"),
        ("p/2024-01-02a.12.0", "minor-heading", None, "12", "14:30:00", "Health & Care", "Beds"),
        ("p/2024-01-02a.12.1", "speech", None, "12", "14:30:00", "Health & Care", "No member here."),
        ("p/2024-01-02a.12.2", "speech", "Bo Else", "12", "14:30:00", "Health & Care", "Yes."),
    ]
    assert [(r.tag, r.n) for r in proceedings.unknown(docs, ["day"]).collect()] == [("hs_Odd", 1)]


def test_an_old_paragraph_is_claimed_once(spark):
    from hustings.plans import alignment

    old, new = "a b c d e f g h\nkept line", "a b c d e f g X\na b c d e f g h i\nkept line"
    docs = spark.createDataFrame([("w", 1, old), ("w", 2, new)], "work string, version int, text string")
    got = {r.seq: (r.kind, r.target) for r in alignment.redirects(docs, "work", "version", "text").collect()}
    assert got == {0: ("multiplecover", 0), 1: ("changes", 0), 2: ("perfectmatch", 1)}


def test_history_passes_over_rows_without_a_speaker(spark):
    from hustings.plans import resolution

    speeches = spark.createDataFrame([("s", 1, "ann"), ("s", 2, "bo"), ("s", 3, None), ("s", 4, None)], "sitting string, seq int, person string")
    found = spark.createDataFrame([("s", q, p) for q in (3, 4) for p in ("ann", "bo")], "sitting string, seq int, person string")
    got = {r.seq: (r.person, r.source) for r in resolution.by_history(speeches, found).collect()}
    assert got[3] == ("ann", "history") and got[4] == ("ann", "history")


def test_documents_are_cut_where_they_lie(spark):
    from hustings.functions import dates
    from hustings.plans import proceedings

    xml = (
        "<S><hs_Timeline>9.05 am</hs_Timeline><Question><hs_Para><Number>7</Number>. <Uin>[12]</Uin><!-- <B> --><Member><B>Ann\n Other</B>:</Member><column number='3'/>"
        "<QuestionText></QuestionText>Is it&nbsp;so?</hs_Para></Question></hs_Para>lost<hs_time>noon</hs_time><hs_Para>not at level one</hs_Para><Division/><hs_Para>seen</hs_Para></S>"
    )
    found = proceedings.blocks(spark.createDataFrame([(1, xml), (2, None), (3, "<S/>")], "day int, xml string"), ["day"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not any(step in plan for step in ("Exchange", "Sort", "Window"))
    got = [(r.day, r.block, r.kind, r.column, r.last_column, r.time, r.member, r.Number, r.QuestionText, r.rest, r.after, r.whole) for r in found.orderBy("block").collect()]
    assert got == [
        (1, 1, "time", None, None, None, None, None, None, "9.05 am", None, "9.05 am"),
        (1, 2, "question", None, "3", "09:05:00", "Ann Other:", "7", None, ". Is it so?", "Is it so?", "7. [12]Ann Other:Is it so?"),
    ]
    times = ["2.30 pm", "12.05 am", "12 p.m.", "14:05", "14:05:09", "25:00", "9.75", " Noon ", "midday", "midnight", "10 o'clock", "10 o'clock p.m", "words", "", "at 7", "123", "3 pm\n"]
    rows = spark.createDataFrame([(t,) for t in times], "t string").select("t", dates.clock(F.trim("t")).alias("c")).collect()
    assert {r.t: r.c for r in rows} == {t: dates.clock_of(t) for t in times}


def test_versions_are_led_to_the_first_in_one_shuffle(spark):
    from hustings.plans import alignment

    first = "a b c d e\nsame\nsame\n\nold words of a line\nend"
    docs = [("w", "w-1", first), ("w", "w-2", "same\nnew\na b c d f\nold words of the line\nsame\nsame\nend"), ("w", "w-3", None), ("w", None, "x"), (None, "n-1", "x"), ("v", "v-1", None), ("v", "v-2", "alone\n  ")]
    found = alignment.redirects(spark.createDataFrame(docs, "work string, version string, text string"), "work", "version", "text")
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    got = sorted((r.version, r.seq, r.kind, r.target) for r in found.collect())
    assert got == [
        ("v-2", 0, "missing", None), ("v-2", 1, "missing", None),
        ("w-2", 0, "perfectmatch", 1), ("w-2", 1, "missing", None), ("w-2", 2, "changes", 0), ("w-2", 3, "changes", 4),
        ("w-2", 4, "perfectmatch", 2), ("w-2", 5, "missing", None), ("w-2", 6, "perfectmatch", 5),
    ]
