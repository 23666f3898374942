"""Ordered rows: events stand for speeches, a user for a sitting."""

from pyspark.sql import functions as F

from hustings.operators import sequences
from hustings.queries import query

BY = ["user_id"]
ORDER = ["ts", "event_id"]


def day():
    return F.to_date("ts")


def events(t):
    return t("events").select("event_id", "user_id", "ts", "event_type", "value", "props")


@query("""WITH a AS (SELECT *, CASE WHEN event_type IS NOT DISTINCT FROM lag(event_type) OVER w AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS turn FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
b AS (SELECT *, sum(turn) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM a)
SELECT user_id, CAST(run AS BIGINT) AS run, event_type, count(*) AS n, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_at, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_at FROM b GROUP BY user_id, run, event_type""")
def collapse_runs(t):
    runs = sequences.collapse_runs(events(t), BY, ORDER, "event_type")
    return runs.select("user_id", "run", "event_type", "n", *(F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("first_at", "last_at")))


@query("""SELECT event_id, last_value(CASE WHEN event_type = 'signup' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS carried FROM events""")
def carry_forward(t):
    """The last sign-up's value, carried on day by day so that no user's whole history meets in one window."""
    value = F.when(F.col("event_type") == "signup", F.col("value"))
    return sequences.carry_forward(events(t), BY, ORDER, value, "carried", day()).select("event_id", "carried")


@query("""WITH m AS (SELECT event_id, user_id, ts, sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS major FROM events)
SELECT event_id, CAST(major AS BIGINT) AS major, row_number() OVER (PARTITION BY user_id, major ORDER BY ts, event_id) - CASE WHEN major > 0 THEN 1 ELSE 0 END AS minor FROM m""")
def hierarchical_ids(t):
    numbered = sequences.hierarchical_ids(events(t), BY, ORDER, F.col("event_type") == "signup", day())
    return numbered.select("event_id", F.col("major").cast("long"), F.col("minor").cast("long"))


@query("""WITH a AS (SELECT *, CASE WHEN event_type IS NOT DISTINCT FROM lag(event_type) OVER w THEN 0 ELSE 1 END AS turn FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
b AS (SELECT *, sum(turn) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM a),
c AS (SELECT *, row_number() OVER r AS n, lead(props) OVER r AS following FROM b WINDOW r AS (PARTITION BY user_id, run ORDER BY ts, event_id))
SELECT event_id, CASE WHEN following IS NULL THEN props ELSE props || ' ' || following END AS merged FROM c WHERE n % 2 = 1""")
def merge_adjacent(t):
    return sequences.merge_adjacent(events(t), BY, ORDER, "event_type", "props").select("event_id", "merged")


@query("SELECT event_id, CAST(epoch(date_trunc('second', ts)) - epoch(date_trunc('second', lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) AS BIGINT) AS gap_seconds FROM events")
def gap_durations(t):
    return sequences.gaps(events(t), BY, ORDER, "ts").select("event_id", "gap_seconds")


@query("""WITH g AS (SELECT event_id, date_diff('minute', lag(date_trunc('minute', ts)) OVER (PARTITION BY user_id ORDER BY event_id), date_trunc('minute', ts)) AS step FROM events)
SELECT event_id, CASE WHEN step IS NULL THEN 'first' WHEN step < 0 THEN 'back' WHEN step > 600 THEN 'jump' ELSE 'on' END AS state FROM g""")
def time_monotonic(t):
    """Whether time goes on from one row to the next."""
    from pyspark.sql import Window

    minute = F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / 60)
    step = minute - F.lag(minute).over(Window.partitionBy("user_id").orderBy("event_id"))
    state = F.when(F.col("step").isNull(), "first").when(F.col("step") < 0, "back").when(F.col("step") > 600, "jump").otherwise("on")
    return events(t).withColumn("step", step).select("event_id", state.alias("state"))


@query("SELECT o_orderkey, o_custkey || '/' || CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS VARCHAR) AS id FROM orders")
def occurrence_suffix(t):
    o = sequences.occurrence(t("orders").select("o_orderkey", "o_custkey", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return o.select("o_orderkey", F.concat_ws("/", F.col("o_custkey").cast("string"), F.col("occurrence").cast("string")).alias("id"))


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders")
def ranked_report(t):
    """Every order's place by price, without one task that sees them all."""
    return sequences.global_rank(t("orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.asc("o_orderkey")]).select("o_orderkey", "place")


@query("""SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, hour(ts) AS hour, count(DISTINCT user_id) AS n_users, CASE WHEN count(DISTINCT user_id) = 1 THEN min(user_id) END AS only_user FROM events GROUP BY 1, 2""")
def sole_speaker(t):
    """Stretches between time marks in which just one user was active."""
    e = t("events").groupBy(F.to_date("ts").cast("string").alias("day"), F.hour("ts").cast("long").alias("hour")).agg(F.count_distinct("user_id").alias("n_users"), F.min("user_id").alias("_u"))
    return e.select("day", "hour", "n_users", F.when(F.col("n_users") == 1, F.col("_u")).alias("only_user"))


@query("""WITH g AS (SELECT conv_id, turn, role, text, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS exchange FROM conversations)
SELECT conv_id, CAST(exchange AS BIGINT) AS exchange, count(*) AS n_turns, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM g GROUP BY 1, 2""")
def question_groups(t):
    """Turns of a conversation grouped under the question that they answer."""
    c = sequences.running_count(t("conversations"), ["conv_id"], ["turn"], F.col("role") == "user", "exchange")
    return c.groupBy("conv_id", "exchange").agg(F.count("*").alias("n_turns"), F.sum(F.length("text")).alias("n_chars"))
