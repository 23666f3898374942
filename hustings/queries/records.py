"""Composite jobs: resolution of names, phrases, versions of documents, and streams held against batches."""

from pyspark.sql import functions as F

from hustings.plans import linking, phrases, resolution
from hustings.queries import query
from hustings.sources.shared import shared_folder
from hustings.streaming import ingest, revisions, states


def _cut(pieces: str, kind: str, pattern: str) -> str:
    """The DuckDB expression that cuts the unclaimed ones of pieces at a pattern's matches."""
    pattern = pattern.replace("'", "''")
    parts = f"string_split(regexp_replace(s.token, '({pattern})', chr(57344) || '\\1' || chr(57344), 'g'), chr(57344))"
    return f"flatten(list_transform({pieces}, lambda s: CASE WHEN s.kind = 'text' THEN list_transform({parts}, lambda x, i: {{'kind': CASE WHEN i % 2 = 0 THEN '{kind}' ELSE 'text' END, 'token': x}}) ELSE [s] END))"


_steps = ["p0 AS (SELECT doc_id, [{'kind': 'text', 'token': replace(text, chr(57344), '')}] AS k FROM documents WHERE text IS NOT NULL)"]
for _n, (_kind, _pattern) in enumerate(phrases.RECOGNISERS):
    _steps.append(f"p{_n + 1} AS (SELECT doc_id, {_cut('k', _kind, _pattern)} AS k FROM p{_n})")
PHRASES = f"WITH {', '.join(_steps)}, c AS (SELECT doc_id, list_filter(k, lambda s: s.token <> '') AS k FROM p{len(phrases.RECOGNISERS)}) SELECT doc_id, CAST(i - 1 AS INTEGER) AS seq, k[i].kind AS kind, k[i].token AS token FROM c, unnest(range(1, len(k) + 1)) AS r(i)"


@query(PHRASES)
def phrase_tokens(t):
    """All documents cut into typed tokens; joined again they are the text."""
    return phrases.tokenize(t("documents").select("doc_id", "text"), "doc_id", "text")


@query("""WITH t AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS start_date, coalesce(lead(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey) - INTERVAL 1 DAY, DATE '9999-12-31')::DATE AS end_date FROM orders),
alias AS (SELECT t.o_custkey AS person, c.c_name AS name, n.n_name AS seat, start_date, end_date FROM t JOIN customer c ON c.c_custkey = t.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey),
probe AS (SELECT e.event_id, c.c_name AS name, CASE WHEN e.event_id % 2 = 0 THEN n.n_name END AS seat, DATE '1996-01-01' + CAST(e.event_id % 1500 AS INTEGER) AS day FROM events e JOIN customer c ON c.c_custkey = e.user_id JOIN nation n ON n.n_nationkey = c.c_nationkey),
found AS (SELECT p.event_id, a.person FROM probe p JOIN alias a ON a.name = p.name AND p.day BETWEEN a.start_date AND a.end_date AND (p.seat IS NULL OR a.seat = p.seat))
SELECT p.event_id, count(DISTINCT f.person) AS n_candidates, CASE count(DISTINCT f.person) WHEN 0 THEN 'none' WHEN 1 THEN 'match' ELSE 'multiple' END AS status, CASE WHEN count(DISTINCT f.person) = 1 THEN min(f.person) END AS match FROM probe p LEFT JOIN found f ON f.event_id = p.event_id GROUP BY 1""")
def resolve_names(t):
    """Who is meant by a name, and perhaps a seat, on a day."""
    from hustings.queries.temporal import terms

    people = t("customer").join(F.broadcast(t("nation")), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_name", F.col("n_name").alias("seat"))
    spans = terms(t).join(people, F.col("o_custkey") == F.col("c_custkey"))
    aliases = resolution.aliases(spans.select(F.col("o_custkey").alias("person"), F.col("c_name").alias("name"), "seat", "start_date", "end_date"))
    probes = t("events").join(people, F.col("user_id") == F.col("c_custkey")).select("event_id", F.col("c_name").alias("name"), F.when(F.col("event_id") % 2 == 0, F.col("seat")).alias("seat"), F.date_add(F.lit("1996-01-01").cast("date"), (F.col("event_id") % 1500).cast("int")).alias("day"))
    return resolution.resolve(probes, aliases, "event_id")


@query("""WITH k AS (SELECT doc_id, unnest(regexp_extract_all(text, '([A-Z][a-z]+ [A-Z][a-z]+)', 1)) AS phrase FROM documents) SELECT phrase, count(DISTINCT doc_id) AS n_documents, count(*) AS n FROM k GROUP BY 1""")
def capitalised_phrases(t):
    """Names found in texts, how often and in how many documents: candidates for links."""
    return linking.mentions(t("documents").select("doc_id", "text"), "doc_id", "text", r"([A-Z][a-z]+ [A-Z][a-z]+)").groupBy("phrase").agg(F.count_distinct("doc_id").alias("n_documents"), F.count("*").alias("n"))


@query("""WITH title AS (SELECT p_partkey, replace(p_name, ' ', '_') AS title, p_partkey % 4 = 0 AS is_redirect, p_partkey % 11 = 0 AS ambiguous FROM part),
final AS (SELECT t.p_partkey, coalesce(r.title, t.title) AS final, coalesce(r.ambiguous, t.ambiguous) AS ambiguous FROM title t LEFT JOIN title r ON t.is_redirect AND r.p_partkey = t.p_partkey - 1)
SELECT p_partkey, final, ambiguous FROM final""")
def title_lookup(t):
    """Page titles with redirects led to the page they stand for."""
    pages = t("part").select("p_partkey", F.translate("p_name", " ", "_").alias("title"), (F.col("p_partkey") % 11 == 0).alias("ambiguous"))
    redirects = t("part").filter("p_partkey % 4 = 0").select("p_partkey", (F.col("p_partkey") - 1).alias("target"))
    return linking.final_titles(pages, redirects, "p_partkey")


STREAM_COUNTS = "SELECT strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2"


@query(STREAM_COUNTS)
def stream_daily_counts(t):
    """Events as a file stream, counted by day with a watermark, run until all files are read."""
    return ingest.drain(ingest.daily_counts(ingest.file_stream(t.spark, t.path("events"))), "complete")


@query("SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY 1, 2")
def stream_first_seen(t):
    """The first event of each user and type, by a stream that merges every batch into what it holds."""
    return ingest.first_seen(ingest.file_stream(t.spark, t.path("events")), ["user_id", "event_type"], "event_id")


@query("""WITH a AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM events), b AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM a)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS started, count(*) AS n FROM b GROUP BY user_id, s""")
def stream_sessions(t):
    """Sessions of events not six hours apart."""
    return ingest.drain(ingest.sessions(ingest.file_stream(t.spark, t.path("events"))), "complete")


@query("""SELECT user_id, count(*) AS n, CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS n_errors, max(event_id) AS last_event FROM events GROUP BY 1""")
def stream_state(t):
    """A state for each user, kept by the stream from batch to batch."""
    return ingest.user_states(ingest.file_stream(t.spark, t.path("events")))


RULES = states.Rules(
    "unknown",
    {("unknown", "view"): "requested", ("requested", "click"): "tried", ("tried", "click"): "tried", ("requested", "purchase"): "answered", ("tried", "purchase"): "answered", ("tried", "error"): "requested", ("answered", "signup"): "requested"},
    {"tried": (43_200, "requested")},
)


@query("""WITH RECURSIVE e AS (SELECT user_id, event_id, event_type, epoch_ms(ts) AS at, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
rules AS (SELECT * FROM (VALUES ('unknown', 'view', 'requested'), ('requested', 'click', 'tried'), ('tried', 'click', 'tried'), ('requested', 'purchase', 'answered'), ('tried', 'purchase', 'answered'), ('tried', 'error', 'requested'), ('answered', 'signup', 'requested')) AS r(was, event, now)),
fold AS (SELECT user_id, CAST(0 AS BIGINT) AS n, 'unknown' AS state, CAST(0 AS BIGINT) AS since, CAST(NULL AS BIGINT) AS at, CAST(NULL AS BIGINT) AS event_id, CAST(NULL AS VARCHAR) AS was, FALSE AS moved, FALSE AS timed FROM (SELECT DISTINCT user_id FROM events)
  UNION ALL SELECT e.user_id, e.n, coalesce(r.now, s.state), CASE WHEN r.now IS NOT NULL THEN e.at ELSE s.since END, e.at, e.event_id, s.state, r.now IS NOT NULL, s.timed
  FROM (SELECT user_id, f.n, e2.n AS next, CASE WHEN f.state = 'tried' AND f.since + 43200000 <= e2.at THEN 'requested' ELSE f.state END AS state, CASE WHEN f.state = 'tried' AND f.since + 43200000 <= e2.at THEN f.since + 43200000 ELSE f.since END AS since, f.state = 'tried' AND f.since + 43200000 <= e2.at AS timed
    FROM fold f JOIN e e2 USING (user_id) WHERE e2.n = f.n + 1) s(user_id, n, next, state, since, timed) JOIN e ON e.user_id = s.user_id AND e.n = s.next LEFT JOIN rules r ON r.was = s.state AND r.event = e.event_type),
last AS (SELECT user_id, arg_max(state, n) AS state, arg_max(since, n) AS since, count(*) FILTER (moved) + count(*) FILTER (timed) AS moves FROM fold GROUP BY user_id),
ends AS (SELECT *, state = 'tried' AND since + 43200000 <= (SELECT epoch_ms(max(ts)) FROM events) AS over FROM last WHERE moves > 0)
SELECT user_id, CASE WHEN over THEN 'requested' ELSE state END AS state, CASE WHEN over THEN since + 43200000 ELSE since END AS since_ms, moves + CASE WHEN over THEN 1 ELSE 0 END AS moves FROM ends""")
def stream_machine(t):
    """Where each user stands by rules with a timeout, after three runs of a stream that each find ten days more of events."""
    events, folder, work = t("events"), shared_folder(t.spark), shared_folder(t.spark)
    for low, high in (("2024-01-01", "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", "9999-01-01")):
        day = F.to_date("ts")
        events.filter((day < high) if low == "2024-01-01" else (day >= low) & (day < high)).write.mode("append").parquet(folder)
        moves = ingest.drain(states.transitions(states.stream_of(t.spark, folder, events.schema), "user_id", "event_type", RULES), "append", work)
    return states.current(moves, "user_id")


@query("""SELECT doc_id, 1 + CAST(doc_id % 3 AS INTEGER) AS revision, md5(coalesce(text, '') || CASE WHEN doc_id % 3 = 0 THEN '' WHEN doc_id % 3 = 1 THEN '2' ELSE '3' END) AS digest FROM documents""")
def stream_revisions(t):
    """Documents in up to three revisions whose files come in the wrong order, and one that never gets its predecessor."""
    docs, folder, work = t("documents"), shared_folder(t.spark), shared_folder(t.spark)
    body = F.coalesce("text", F.lit(""))
    for revision in (3, 5, 1, 2):
        some = docs.filter(F.col("doc_id") % 3 >= min(revision, 3) - 1).select("doc_id", F.lit(revision).alias("revision"), (body if revision == 1 else F.concat(body, F.lit(str(revision)))).alias("text"))
        some.write.mode("append").parquet(folder)
        done = revisions.apply(states.stream_of(t.spark, folder, some.schema), "doc_id", work)
    return revisions.current(done, "doc_id").select("doc_id", "revision", F.md5("text").alias("digest"))
