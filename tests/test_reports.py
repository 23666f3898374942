"""Report grammars on inputs that are told in full."""

from pyspark.sql import functions as F

from hustings.plans import reports

PAGE = """<div class="or"><h1>Business</h1><p>Before anyone.</p><p class="lead" id="h1">Topical Questions</p>
<div><strong><a href="/msps/1" name="m1">Ann Bee (Lab)</a></strong></div><p id="a1">To ask.</p><p>Again <b>now</b>.</p>
<p id="s2"><strong><a href="/msps/2" name="m2">Mr Cee</a></strong></p><p>I answer.</p><ul><li>one</li><li>two</li></ul>
<p class="or-contribution-box"><span class="or-bill-section-bold">Members:</span> No.</p>
<strong><a name="0">Reverend Dee</a></strong><p>There will be a division.</p><p>For</p><p>Bee, Ann (Leith) (Lab)<br/>Cee, Mr (Bute) (SNP)</p>
<p><span class="or-bill-section-bold">Against</span></p><p>Eff, Jo (Ayr)</p><p>The result is known.</p><p class="lead">Next item</p><p>Late words.</p></div>"""


def test_speeches_headings_and_divisions(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, None), (3, "<p>only words")], "id int, html string")
    speeches, votes = reports.report(pages, "id", "html")
    told = [(r["kind"], r["speaker"], r["href"], r["member"], r["text"]) for r in speeches.filter("id = 1").orderBy("seq").collect()]
    assert told == [
        ("speech", None, None, None, "Before anyone."), ("heading", None, None, None, "Topical Questions"), ("speech", "Ann Bee (Lab)", "/msps/1", "m1", "To ask.\nAgain now."),
        ("speech", "Mr Cee", "/msps/2", "m2", "I answer.\nonetwo"), ("speech", "Members:", None, None, "No."), ("speech", "Reverend Dee", None, "0", "There will be a division."),
        ("division", "Reverend Dee", None, "0", ""), ("speech", "Reverend Dee", None, "0", "The result is known."), ("heading", None, None, None, "Next item"), ("speech", None, None, None, "Late words."),
    ]
    assert [(r["vote"], r["name"]) for r in votes.orderBy("vote", "name").collect()] == [("against", "Eff, Jo (Ayr)"), ("for", "Bee, Ann (Leith) (Lab)"), ("for", "Cee, Mr (Bute) (SNP)")]
    assert [tuple(r) for r in reports.counts(votes, "id").collect()] == [(1, 1, 2, 1, 0)]
    assert [(r["id"], r["kind"], r["text"]) for r in speeches.filter("id > 1").collect()] == [(3, "speech", "only words")]


def test_division_ways(spark):
    cases = {
        "  For ": ("FOR", None), "nonsense": None, "abstentions ": ("ABSTENTIONS", None), ": FOR": ("FOR", None), "Abstention": ("ABSTENTIONS", None), "Absentions": ("ABSTENTIONS", None),
        "VOTES FOR DONALD DEWAR": ("FOR", "Donald Dewar"), "now cast your votes for someone": None, "For Mr Kenneth Macintosh": ("FOR", "Mr Kenneth Macintosh"), "For option 1": ("FOR", "Option 1"),
        "The following member took the oath:": ("FOR", "oath"), "The following member made a solemn affirmation:": ("FOR", "affirmation"),
        "The following member made a solemn affirmation and repeated it in French:": ("FOR", "affirmation"), "FOR " + "x " * 200: None, None: None,
    }
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(cases)], "i int, s string").select("i", reports.division_way(F.col("s")).alias("w")).orderBy("i").collect()
    assert [None if r["w"] is None else tuple(r["w"]) for r in rows] == list(cases.values())


def test_voters(spark):
    cases = {
        "Something random...": None, "Baillie, Jackie (Dumbarton) (Lab)": ("Jackie Baillie", "Dumbarton", "Lab"), "Alexander, Ms Wendy (Paisley North) (Lab)": ("Ms Wendy Alexander", "Paisley North", "Lab"),
        "Purvis, Jeremy (Tweeddale, Ettrick and Lauderdale)": ("Jeremy Purvis", "Tweeddale, Ettrick and Lauderdale", None), ": SP 440 (EC Ref No 11766/99, COM(99) 473 final)": None,
        "SP 666 (EC Ref No 566 99/0225, COM(99) (CNS))": None, "to promote a private bill, the company relied on its general power under section 10(1)(xxxii)": None,
        "Brian Adam (North-East Scotland) (SNP)": ("Brian Adam", "North-East Scotland", "SNP"),
    }
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(cases)], "i int, s string").select("i", reports.voter(F.col("s")).alias("v")).orderBy("i").collect()
    assert [None if r["v"] is None else tuple(r["v"]) for r in rows] == list(cases.values())
