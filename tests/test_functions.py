"""Column functions on hand-made values."""

import datetime

import pytest
from pyspark.sql import functions as F

from hustings.functions import dates, markup, names, text


@pytest.fixture
def one(spark):
    def evaluate(column, **values):
        df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)) if values else spark.range(1)
        return df.select(column.alias("x")).first().x

    return evaluate


def test_text(one):
    s = F.col("s")
    assert one(text.strip_punctuation(s), s="Van-der Berg, A") == "vanderberga"
    assert one(text.tidy(s), s=" : a  b\n") == "a b"
    assert one(text.slugify(s), s="Élan  Vital: 100% (ok)") == "elan-vital-100-ok"
    assert one(text.slugify(s, fold=False), s="A b") == "a-b"
    assert one(text.title_words(s), s="fooBarHTMLPage") == "Foo Bar HTML Page"
    assert one(text.wiki_title(s), s="the  house of: commons") == "House_of:commons"
    assert one(text.wiki_title(s), s="état") == "État"
    assert [one(text.alpha_order(s), s=x) for x in ("a", "z", "aa")] == [1, 26, 31]
    assert [one(text.next_alpha(s), s=x) for x in ("", "a", "z", "az", "ba", "zz")] == ["a", "b", "aa", "ba", "bb", "aaa"]
    assert one(text.markup_tokens(s), s="<p>It is &amp; was</p>") == ["<p>", "It", "is", "&amp;", "was", "</p>"]
    assert one(text.sentences(s, 2, ("secret",)), s="One two. Three. A secret thing. Four five") == ["One two", "Four five"]
    assert [one(text.phrase_fault(s, ("General Debate",)), s=x) for x in ("Abcd", "NHS", "NATOBASE", "NATO-x", "42", "Wales Office", "GREAT SEAL", "general debate", "General Debate", " A ", "\u00c9T\u00c9", "\u00c9t\u00e9", "")] == ["single word", None, None, "single word", "single word", None, None, None, "banned", None, None, "single word", None]
    assert [one(text.bits_to_int(s), s=x) for x in ("0101", "", "1" * 70)] == [5, 0, (1 << 63) - 1]
    assert one(text.similarity_to()(s, F.lit("a b c d")), s="a b c e") == 0.75
    assert text.snake_case("primarySponsorID") == "primary_sponsor_id" and text.camel_case("member_id", pascal=True) == "MemberID"


def test_names(one):
    s = F.col("s")
    assert tuple(one(names.strip_titles(s), s="Rt. Hon. Sir Ann Other, KC, MP")) == ("Ann Other", 3)
    assert one(names.reorder(s), s="Other, Ann") == "Ann Other"
    assert tuple(one(names.split_name(s), s="Ann de la Other")) == ("Ann de la", "Other") and tuple(one(names.split_name(s), s="Ann van Other")) == ("Ann", "van Other")
    assert one(names.family_case(s), s="MCDONALD O'NEIL CLIFTON-BROWN") == "McDonald O'Neil Clifton-Brown"
    assert one(names.brackets(s), s="The Clerk (Ann Other) (Leeds)").inside == ["Ann Other", "Leeds"]
    assert tuple(one(names.vote_line(s), s="Other, Ann (Leeds) (Lab)")) == ("Other", "Ann", "Leeds", "Lab")
    assert tuple(one(names.vote_line(s), s="Ann Other (Lab)"))[:2] == ("Other", "Ann") and one(names.vote_line(s), s="Ann Other (Lab)").party == "Lab"
    assert tuple(one(names.peer(s), s="The Lord Bishop of Ely")) == (True, "Lord Bishop", None, "Ely")
    assert tuple(one(names.peer(s), s="Baroness Smith of Leeds")) == (False, "Baroness", "Smith", "Leeds")
    assert one(names.strip_patterns(s, ["Deputy", "Mayor of \\w+"]), s="Deputy Mayor of X Ann") == "Ann"


def test_dates(one):
    s = F.col("s")
    day = datetime.date(2024, 3, 5)
    for written in ("2024-03-05", "5 March 2024", "05/03/2024", "Tuesday, 5 March 2024"):
        assert one(dates.parse_date(s), s=written) == day
    assert one(dates.parse_date(s), s="nonsense") is None
    assert one(dates.english_months(s), s="5 Mawrth 2024") == "5 March 2024"
    assert one(dates.date_in(s), s="debates2024-03-05b.xml") == day and one(dates.date_in(s), s="x2024-13-05") is None
    assert [one(dates.clock(s), s=x) for x in ("2.30 pm", "12.05 am", "14:05", "noon", "midnight", "10 o'clock", "words")] == ["14:30:00", "00:05:00", "14:05:00", "12:00:00", "00:00:00", "10:00:00", None]
    assert one(dates.previous_sitting_day(s.cast("date")), s="2024-03-04") == datetime.date(2024, 3, 1)
    assert one(dates.session_name(s), s="2016_2017") == "2016-17"
    assert one(dates.fuzzy_date(s), s="on the 5th of March, 2024") == day and one(dates.fuzzy_date(s), s="?") is None


def test_markup(one):
    s = F.col("s")
    assert one(markup.text_of(s), s="<p>a\n<b>b</b></p>") == "a b"
    assert one(markup.clean(s), s="<!-- x --><a href='y'>a</a><script>var b='</p>'</script>  c") == "a c"
    assert one(markup.escape(s), s='a & <b> &amp; "c"') == "a &amp; &lt;b&gt; &amp; &quot;c&quot;"
    assert one(markup.unescape_basic(s), s="&lt;b&gt; &amp;") == "<b> &" and one(markup.unescape(s), s="&eacute;&#33;") == "é!"
    assert one(markup.unknown_entities(s), s="&amp; &foo; &foo;") == ["foo"]
    assert one(markup.escape_unknown_tags(s, ("p", "b")), s="<p><foo>x</foo></p>") == "<p>&lt;foo&gt;x&lt;/foo&gt;</p>"
    assert one(markup.straighten_inline(s), s="<strong>a</strong><em> </em><small>b</small>") == "<b>a</b>b"
    assert one(markup.title(s), s="<TITLE> A </TITLE>") == "A" and one(markup.links(s), s='<a href="x"><a href="">') == ["x", ""]
    assert [(p.kind, p.indent, p.text) for p in one(markup.paragraphs(s), s="<p>a</p><ul><li>b</ul><table><tr><p>c</table><h2>d</h2>")] == [("para", 0, "a"), ("item", 1, "b"), ("table", 0, "c"), ("heading", 0, "d")]


def test_common_words_against_the_usual_table():
    import random

    rng = random.Random(2)
    for _ in range(80):
        a, b = (rng.choices("abcd", k=rng.randrange(0, 30)) for _ in range(2))
        row = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                row[i + 1][j + 1] = row[i][j] + 1 if x == y else max(row[i][j + 1], row[i + 1][j])
        assert text.common_words(a, b) == row[-1][-1]


def test_similarity_is_one_measure_at_all_lengths(spark):
    from pyspark.sql import functions as F

    short, long = [f"w{i}" for i in range(40)], [f"w{i}" for i in range(9000)]
    rows = [(" ".join(w), " ".join(reversed(w))) for w in (short, long)] + [("a b", "a b"), ("", ""), (None, "a"), ("a", "")]
    got = [r.s for r in spark.createDataFrame(rows, "a string, b string").coalesce(1).select(text.similarity_to()(F.col("a"), F.col("b")).alias("s")).collect()]
    assert got[2:] == [1.0, 1.0, None, 0.0] and abs(got[0] - 1 / 40) < 1e-9 and abs(got[1] - 1 / 9000) < 1e-9


def test_column_ranges(one):
    s = F.col("s")
    got = [one(text.column_range(s), s=x) for x in ("1234", "1234-6", "1234-40", "9999-10002", "10000-9995", "1234-4", "1234-1", "1234-1234", "1234-1230", "9998-9999", "99-100", "100-99", "5-3", "x", None, "12-")]
    want = [(1234, 1234), (1234, 1236), (1234, 1240), (9999, 10002), (10000, 19995), None, None, None, None, (9998, 9999), (99, 100), (100, 199), None, None, None, None]
    assert [None if g is None else tuple(g) for g in got] == want


def test_texts_go_to_python_in_bounded_batches(spark):
    from hustings.functions import patches, text
    from hustings.sources.shared import BATCH_BYTES

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    for column in (lambda: text.slugify(F.col("s")), lambda: patches.patched(F.col("s"), F.lit(None).cast("string"))["text"]):
        spark.conf.set(name, str(1 << 28))
        got = spark.createDataFrame([("Plain Text",), ("\u00c9lan",), (None,)], "s string").select(column().alias("x")).collect()
        assert int(spark.conf.get(name)) == BATCH_BYTES and got[2].x is None and got[0].x in ("plain-text", "Plain Text")
    plan = spark.createDataFrame([("a",)], "s string").select(text.fold_ascii(F.col("s")))._jdf.queryExecution().optimizedPlan().toString()
    assert "_folded(CASE WHEN" in plan
