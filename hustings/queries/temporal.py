"""Validity intervals: a term is an order that lasts until the day before the customer's next one."""

from pyspark.sql import functions as F

from hustings.operators import sequences, tables, temporal
from hustings.queries import query

TERMS = """terms AS (
  SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus, CAST(o_orderdate AS DATE) AS start_date,
    coalesce(lead(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey) - INTERVAL 1 DAY, DATE '9999-12-31')::DATE AS end_date
  FROM orders)"""
WINDOWS = "win AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS s, (CAST(o_orderdate AS DATE) + INTERVAL 30 DAY)::DATE AS e FROM orders)"


def terms(t):
    orders = t("orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", F.to_date("o_orderdate").alias("start_date"))
    return temporal.derive_ends(orders, ["o_custkey"], "start_date", "o_orderkey")


def windows(t):
    return t("orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("s"), F.date_add(F.to_date("o_orderdate"), 30).alias("e"))


@query(f"""WITH {TERMS}, days AS (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-08-01', INTERVAL 1 MONTH)) AS DATE) AS day),
people AS (SELECT DISTINCT o_custkey FROM orders)
SELECT t.o_orderpriority AS priority, count(*) AS n, count(DISTINCT t.o_custkey) AS n_customers
FROM people p CROSS JOIN days d JOIN terms t ON t.o_custkey = p.o_custkey AND d.day BETWEEN t.start_date AND t.end_date GROUP BY 1""")
def interval_join(t):
    """Whose term holds the first of each month, by priority: the probes are made per customer, then joined by key."""
    days = F.expr("sequence(DATE'1995-01-01', DATE'2001-08-01', INTERVAL 1 MONTH)")
    probes = t("orders").select("o_custkey").distinct().withColumn("day", F.explode(days))
    met = temporal.interval_join(probes, terms(t), ["o_custkey"], "day", "start_date", "end_date")
    return met.groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count("*").alias("n"), F.count_distinct("o_custkey").alias("n_customers"))


@query(f"WITH {TERMS} SELECT o_orderkey, o_custkey, CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date FROM terms")
def derive_end_dates(t):
    return terms(t).select("o_orderkey", "o_custkey", F.col("start_date").cast("string"), F.col("end_date").cast("string"))


@query(f"""WITH {TERMS} SELECT n.n_name, count(*) AS n FROM terms JOIN customer c ON c.c_custkey = o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
WHERE DATE '1998-01-01' BETWEEN start_date AND end_date GROUP BY 1""")
def valid_on_date(t):
    valid = terms(t).filter(temporal.valid_on(F.lit("1998-01-01").cast("date"), F.col("start_date"), F.col("end_date")))
    people = t("customer").join(F.broadcast(t("nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    return valid.join(people, F.col("o_custkey") == F.col("c_custkey")).groupBy("n_name").agg(F.count("*").alias("n"))


@query(f"""WITH {WINDOWS} SELECT a.o_custkey, a.o_orderkey AS first_id, b.o_orderkey AS second_id FROM win a JOIN win b
ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey AND a.s <= b.e AND a.e >= b.s""")
def overlap_conflicts(t):
    return temporal.overlap_conflicts(windows(t), ["o_custkey"], "s", "e", "o_orderkey")


@query("""SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) BETWEEN CAST(o_orderdate AS DATE) AND (CAST(o_orderdate AS DATE) + INTERVAL 90 DAY)::DATE AS contained
FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
def containment_join(t):
    """Line items shipped within ninety days of their order, and those that weren't."""
    line, o = t("lineitem").select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("d")), t("orders").select("o_orderkey", F.to_date("o_orderdate").alias("s"))
    held = o.select(F.col("o_orderkey").alias("k"), "s", F.date_add("s", 90).alias("e"))
    met = temporal.containment(line.withColumn("d2", F.col("d")), held, "l_orderkey", "d", "d2", "s", "e", outer_key="k")
    return met.select("l_orderkey", "l_linenumber", (F.col("n_containers") > 0).alias("contained"))


@query(f"""WITH {WINDOWS}, years AS (SELECT y, make_date(y, 1, 1) AS ys, make_date(y, 12, 31) AS ye FROM unnest(range(1994, 2003)) AS r(y))
SELECT o_orderkey, CAST(y AS INTEGER) AS year, CAST(greatest(s, ys) AS VARCHAR) AS both_start, CAST(least(e, ye) AS VARCHAR) AS both_end FROM win JOIN years ON s <= ye AND e >= ys""")
def interval_intersection(t):
    spark = t.spark
    years = spark.range(1994, 2003).select(F.col("id").cast("int").alias("year"), F.make_date("id", F.lit(1), F.lit(1)).alias("ys"), F.make_date("id", F.lit(12), F.lit(31)).alias("ye"))
    w = windows(t).withColumn("_y", F.explode(F.sequence(F.year("s"), F.year("e"))))
    both = temporal.intersection(w, F.broadcast(years), F.col("_y") == F.col("year"), ("s", "e"), ("ys", "ye"))
    return both.select("o_orderkey", "year", F.col("both_start").cast("string"), F.col("both_end").cast("string"))


@query(f"""WITH {WINDOWS} SELECT o_orderkey, CAST(y AS INTEGER) AS year, date_diff('day', greatest(s, make_date(y, 1, 1)), least(e, make_date(y, 12, 31))) + 1 AS days
FROM win, unnest(range(year(s), year(e) + 1)) AS r(y)""")
def interval_split(t):
    pieces = temporal.split_at_years(windows(t), "s", "e")
    return pieces.select("o_orderkey", "year", (F.date_diff("piece_end", "piece_start") + 1).cast("long").alias("days"))


@query("""WITH pos AS (SELECT c_custkey AS k, DATE '1996-01-01' AS s, DATE '1999-12-31' AS e FROM customer),
inn AS (SELECT o_custkey AS k, CAST(o_orderdate AS DATE) AS s, (CAST(o_orderdate AS DATE) + INTERVAL 30 DAY)::DATE AS e FROM orders WHERE o_orderpriority = '1-URGENT'),
cuts AS (SELECT k, s AS d FROM pos UNION SELECT i.k, i.s FROM inn i JOIN pos p ON p.k = i.k AND i.s > p.s AND i.s <= p.e UNION SELECT i.k, (i.e + INTERVAL 1 DAY)::DATE FROM inn i JOIN pos p ON p.k = i.k AND i.e + INTERVAL 1 DAY > p.s AND i.e + INTERVAL 1 DAY <= p.e),
pieces AS (SELECT k, d AS s, coalesce(lead(d) OVER (PARTITION BY k ORDER BY d) - INTERVAL 1 DAY, DATE '1999-12-31')::DATE AS e FROM cuts)
SELECT k AS c_custkey, CAST(s AS VARCHAR) AS start_date, CAST(e AS VARCHAR) AS end_date, EXISTS (SELECT 1 FROM inn i WHERE i.k = pieces.k AND i.s <= pieces.s AND i.e >= pieces.e) AS inside FROM pieces""")
def interval_carve(t):
    """A post of each customer, cut where urgent orders' windows begin and end."""
    post = t("customer").select("c_custkey", F.lit("1996-01-01").cast("date").alias("start_date"), F.lit("1999-12-31").cast("date").alias("end_date"))
    inner = t("orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"), F.to_date("o_orderdate").alias("start_date"), F.date_add(F.to_date("o_orderdate"), 30).alias("end_date"))
    return temporal.carve(post, inner, "c_custkey").select("c_custkey", F.col("start_date").cast("string"), F.col("end_date").cast("string"), "inside")


@query(f"""WITH {WINDOWS}, m AS (SELECT *, max(e) OVER (PARTITION BY o_custkey ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM win),
i AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach + INTERVAL 1 DAY THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM m)
SELECT o_custkey, CAST(min(s) AS VARCHAR) AS s, CAST(max(e) AS VARCHAR) AS e, count(*) AS n_merged FROM i GROUP BY o_custkey, island""")
def contiguous_terms(t):
    return temporal.contiguous(windows(t), ["o_custkey"], "s", "e").select("o_custkey", F.col("s").cast("string"), F.col("e").cast("string"), "n_merged")


@query("""SELECT p.event_id, (SELECT max_by(v.event_id, (v.ts, v.event_id)) FROM events v WHERE v.user_id = p.user_id AND v.event_type = 'view' AND (v.ts, v.event_id) < (p.ts, p.event_id)) AS latest_view
FROM events p WHERE p.event_type = 'purchase'""")
def asof_last_event(t):
    """For each purchase the user's latest view before it."""
    e = t("events")
    left = e.filter("event_type = 'purchase'").select("user_id", "ts", "event_id")
    right = e.filter("event_type = 'view'").select("user_id", "ts", "event_id", F.col("event_id").alias("view"))
    return temporal.as_of(left, right, ["user_id"], "ts", ["event_id"], "view").select("event_id", "latest_view")


@query("""SELECT CAST(d AS VARCHAR) AS day, l.l_returnflag AS flag, CAST(count(*) AS BIGINT) AS total FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d, l_returnflag FROM lineitem) x
JOIN lineitem l ON l.l_returnflag = x.l_returnflag AND CAST(l.l_shipdate AS DATE) <= x.d GROUP BY 1, 2""")
def cumulative_snapshots(t):
    rows = t("lineitem").select(F.to_date("l_shipdate").alias("day"), F.col("l_returnflag").alias("flag"))
    return temporal.cumulative_snapshots(rows, "day", ["flag"], F.lit(1)).select(F.col("day").cast("string"), "flag", "total")


@query(f"""WITH {TERMS} SELECT o_orderkey FROM terms WHERE end_date >= DATE '1998-06-01' AND start_date <= DATE '1998-06-01' AND start_date >= DATE '1998-06-01' - INTERVAL 365 DAY""")
def snapshot_as_of(t):
    return temporal.snapshot_as_of(terms(t), "1998-06-01", "end_date", "start_date", "start_date").select("o_orderkey")


@query("""WITH days AS (SELECT CAST(unnest(generate_series(DATE '1997-01-01', DATE '1997-03-31', INTERVAL 1 DAY)) AS DATE) AS day)
SELECT CAST(day AS VARCHAR) AS day, count(o_orderkey) AS n FROM days LEFT JOIN orders ON CAST(o_orderdate AS DATE) = day GROUP BY 1""")
def date_spine(t):
    days = temporal.date_spine("1997-01-01", "1997-03-31", t.spark)
    orders = t("orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"))
    return days.join(orders, "day", "left").select(F.col("day").cast("string"), F.coalesce("n", F.lit(0)).alias("n"))


@query("SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'")
def date_range(t):
    """The bounds are compared with the stored column, so the scan gets them."""
    return t("orders").filter("o_orderdate >= TIMESTAMP_NTZ'1997-01-01' and o_orderdate < TIMESTAMP_NTZ'1998-01-01'").select("o_orderkey")


@query(f"""WITH {WINDOWS}, probes AS (SELECT event_id, 9131 + event_id * 7 % 2400 AS day FROM events), days AS (SELECT day, count(*) AS n FROM (SELECT DISTINCT day FROM probes) JOIN win ON day BETWEEN date_diff('day', DATE '1970-01-01', s) AND date_diff('day', DATE '1970-01-01', e) GROUP BY 1)
SELECT event_id, n FROM probes JOIN days USING (day)""")
def range_join(t):
    """Which windows hold a day, with no key to join by: buckets of a month are the key. Windows of the same days are
    counted first, and each day is looked up once."""
    number = lambda c: F.date_diff(c, F.lit("1970-01-01").cast("date")).cast("long")
    ranges = windows(t).groupBy(number("s").alias("a"), number("e").alias("b")).agg(F.count("*").alias("n"))
    points = t("events").select("event_id", (F.lit(9131) + F.col("event_id") * 7 % 2400).alias("day"))
    days = temporal.range_join(points.select("day").distinct(), ranges, "day", "a", "b", 31).groupBy("day").agg(F.sum("n").alias("n"))
    return points.join(days, "day").select("event_id", "n")


@query("""WITH x AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN CAST(year(o_orderdate) AS VARCHAR) WHEN 1 THEN strftime(o_orderdate, '%Y-%m') WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d') END AS d FROM orders)
SELECT o_orderkey, CASE WHEN d IS NULL THEN '0001-01-01' WHEN length(d) = 4 THEN d || '-01-01' WHEN length(d) = 7 THEN d || '-01' ELSE d END AS start_date,
CASE WHEN d IS NULL THEN '9999-12-31' WHEN length(d) = 4 THEN d || '-12-31' WHEN length(d) = 7 THEN CAST(last_day(CAST(d || '-01' AS DATE)) AS VARCHAR) ELSE d END AS end_date FROM x""")
def pad_partial_dates(t):
    o = F.col("o_orderdate")
    part = F.when(F.col("o_orderkey") % 4 == 0, F.date_format(o, "yyyy")).when(F.col("o_orderkey") % 4 == 1, F.date_format(o, "yyyy-MM")).when(F.col("o_orderkey") % 4 == 2, F.date_format(o, "yyyy-MM-dd"))
    x = t("orders").select("o_orderkey", part.alias("d"))
    return x.select("o_orderkey", temporal.pad_date(F.col("d")).cast("string").alias("start_date"), temporal.pad_date(F.col("d"), end=True).cast("string").alias("end_date"))


@query(f"""WITH {TERMS} SELECT o_custkey, max(CASE WHEN end_date = DATE '9999-12-31' THEN o_orderkey END) AS current_key, CAST(max(CASE WHEN end_date = DATE '9999-12-31' THEN start_date END) AS VARCHAR) AS since FROM terms GROUP BY 1""")
def nulls_far_future(t):
    """The term that has no end sorts last and so is each customer's latest."""
    ended = terms(t).withColumn("end_date", F.nullif("end_date", F.lit(temporal.FOREVER).cast("date")))
    last = tables.latest_per_key(ended, ["o_custkey"], [F.coalesce("end_date", F.lit(temporal.FOREVER).cast("date")), F.col("o_orderkey")])
    return last.select("o_custkey", F.col("o_orderkey").alias("current_key"), F.col("start_date").cast("string").alias("since"))


@query("""WITH e AS (SELECT event_id, user_id, event_type, ts, lead(event_id) OVER w AS next_id, lead(event_type) OVER w AS next_kind FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, event_type, next_id FROM e WHERE next_kind = 'purchase'""")
def event_pairs(t):
    e = t("events").select("event_id", "user_id", "event_type", "ts")
    return sequences.event_pairs(e, ["user_id"], ["ts", "event_id"], "event_type", "event_id", "purchase").select("event_id", "event_type", "next_id")
