"""The relay's registered queries, and the same in SQL.

Responses are recorded relations here: pages stand for fetched texts and events for the service's answers.
Their statuses are stand-ins by rule, as the tables have none: a fetch of a page whose number is a multiple
of 7 is a 404, and a post is a 500 where the event is an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.variants import counter, parsed
from ..operators import targets as T
from ..operators.config import addresses
from ..operators.outcomes import accepted, envelope, increments, summary_line, totals


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.typed_targets(_table(spark, sf_dir, "pages"), "page_id", "url")


def targets_scan(spark, sf_dir):
    return _targets(spark, sf_dir)


def targets_discovered(spark, sf_dir):
    return T.discovered(_targets(spark, sf_dir))


def targets_eligible(spark, sf_dir):
    return _targets(spark, sf_dir).where(T.eligible(F.col("feed_id"), F.col("feed_url")))


def targets_skipped(spark, sf_dir):
    return _targets(spark, sf_dir).where(~F.coalesce(T.eligible(F.col("feed_id"), F.col("feed_url")), F.lit(False)))


def payload_accept_pages(spark, sf_dir):
    return _table(spark, sf_dir, "pages").select("page_id", accepted(F.lit(200), F.col("html")).alias("accepted"))


def payload_accept_documents(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", accepted(F.lit(200), F.col("text")).alias("accepted"))


def ingest_envelope(spark, sf_dir):
    return _table(spark, sf_dir, "pages").select("page_id", envelope(F.col("page_id"), F.col("html")).alias("envelope"))


def response_counters(spark, sf_dir):
    document = parsed("props")
    return _table(spark, sf_dir, "events").select("event_id", counter(document, "k").cast("long").alias("processed"), counter(document, "added").cast("long").alias("added"))


def endpoint_normalise(spark, sf_dir):
    discovery, ingest = addresses("url")
    return _table(spark, sf_dir, "pages").select("page_id", discovery.alias("discovery_url"), ingest.alias("ingest_url"))


#: Ends that make an endpoint of a page's host, by the page's number: each way to tell the two addresses, and near misses.
ENDS = ("/relay-ingest", "/scheduler", "//", "/scheduler/", "/relay-ingest/", "/Scheduler", "", "/scheduler?x=1", "/a/relay-ingest")


def endpoint_branches(spark, sf_dir):
    """The addresses of a service on each page's host."""
    host = F.regexp_extract("url", "^[a-z]+://[^/]+", 0)
    endpoint = F.concat(host, F.element_at(F.array(*map(F.lit, ENDS)), (F.col("page_id") % len(ENDS) + 1).cast("int"))).alias("endpoint")
    discovery, ingest = addresses("endpoint")
    return _table(spark, sf_dir, "pages").select("page_id", endpoint).select("page_id", "endpoint", discovery.alias("discovery_url"), ingest.alias("ingest_url"))


#: Targets in a discovery document.
LISTED = 10
#: JSON values in place of a page's number (#) and address (@), by the number, so that each document has values of each kind.
IDS = ("#", '"#"', "0", "0.0", "null", '""', "true", "[null]", "[]", '{"n":#}', "{}")
URLS = ("@", "@", "@", '""', "null", "5", "@")
#: Documents without a list of targets.
BARE = ("{}", '{"targets":[]}', '{"targets":null}', '{"other":[1]}')


def _choice(among: tuple[str, ...], number: str):
    return F.element_at(F.array(*map(F.lit, among)), (F.col(number) % len(among) + 1).cast("int"))


def discovery_documents(spark, sf_dir):
    """list and body: pages as targets, LISTED to a document; every fifth document lists none."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url").where("page_id IS NOT NULL AND url IS NOT NULL")
    filled = [F.replace(_choice(values, "page_id"), F.lit(mark), value) for values, mark, value in ((IDS, "#", F.col("page_id").cast("string")), (URLS, "@", F.concat(F.lit('"'), "url", F.lit('"'))))]
    one = pages.select("page_id", F.floor(F.col("page_id") / LISTED).cast("int").alias("list"), F.concat(F.lit('{"id":'), filled[0], F.lit(',"feed_url":'), filled[1], F.lit("}")).alias("t"))
    # A document has LISTED targets.
    full = one.groupBy("list").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_id", "t"))), lambda x: x["t"]), ",").alias("t"))
    return full.select("list", F.when(F.col("list") % 5 == 4, _choice(BARE, "list")).otherwise(F.concat(F.lit('{"targets":['), "t", F.lit("]}"))).alias("body"))


def variant_targets(spark, sf_dir):
    """The targets of all documents, with values of any type, and whether they count."""
    able = T.eligible(F.col("feed_id"), F.col("feed_url"), variant=True)
    rows = T.listed_targets(discovery_documents(spark, sf_dir), keep=("list",))
    return rows.select("list", F.col("ord").cast("int").alias("ord"), F.when(able, F.to_json("feed_id")).alias("feed_id"), able.alias("eligible"))


#: Answers to posts, by the event's number; # is the number in its props.
ANSWERS = (
    '{"processed":#,"added":2}', "{}", '{"processed":#}', '{"processed":null,"added":#}', '{"processed":#,"added":null}', '{"processed":"#"}',
    '{"processed":true,"added":#}', "[#]", "not JSON #", '{"processed":#,"added":[1]}', '{"added":#}', "#",
)


def post_outcomes(spark, sf_dir):
    """What each event adds up to as an answer: errors are 500, signups 201."""
    k = F.get_json_object("props", "$.k")
    status = F.when(F.col("event_type") == "error", 500).when(F.col("event_type") == "signup", 201).otherwise(200)
    rows = _table(spark, sf_dir, "events").select("event_id", status.alias("post_status"), F.replace(_choice(ANSWERS, "event_id"), F.lit("#"), k).alias("post_body"))
    none = F.lit(None).cast("string")
    got = increments(rows.withColumns({"fetch_status": F.lit(200), "fetch_body": F.lit("<"), "fetch_error": none, "post_error": none}))
    return got.select("event_id", F.col("synced_inc").cast("long").alias("synced_inc"), F.col("added_inc").cast("long").alias("added_inc"), "failed_inc")


def _outcomes(spark, sf_dir, on=None):
    """Every page as a target with its fetch and its answer. The texts end at the scan: what is joined is whether they were accepted."""
    pages = _table(spark, sf_dir, "pages")
    able = F.lit(False) if on is False else F.coalesce(T.eligible(F.col("page_id"), F.col("url")), F.lit(False))
    status = F.when(F.col("page_id") % 7 == 0, 404).otherwise(200)
    fetched = pages.select("page_id", able.alias("eligible"), status.alias("fetch_status"), F.when(accepted(status, F.col("html")), F.lit("<")).alias("fetch_body"), F.lit(None).cast("string").alias("fetch_error"))
    answers = _table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_type") == "error", 500).otherwise(200).alias("post_status"), F.col("props").alias("post_body"), F.lit(None).cast("string").alias("post_error"))
    return increments(fetched.join(answers, fetched["page_id"] == answers["event_id"], "left"), processed="k")


def relay_summary(spark, sf_dir):
    return totals(_outcomes(spark, sf_dir))


def outcome_totals(spark, sf_dir):
    what = F.when(~F.col("eligible"), "skipped").when(F.col("fetch_body").isNull(), "fetch_failed").when(F.col("failed_inc") > 0, "post_failed").otherwise("delivered")
    on = F.when(F.col("eligible"), F.col("synced_inc")).otherwise(0)
    return _outcomes(spark, sf_dir).groupBy(what.alias("outcome")).agg(F.count(F.lit(1)).alias("targets"), F.sum(on).cast("long").alias("synced"))


def line_of_summary(spark, sf_dir):
    return summary_line(relay_summary(spark, sf_dir))


def empty_batch(spark, sf_dir):
    return totals(_outcomes(spark, sf_dir, on=False))


QUERIES = {
    "relay_summary": relay_summary, "targets_scan": targets_scan, "targets_discovered": targets_discovered,
    "targets_eligible": targets_eligible, "targets_skipped": targets_skipped, "payload_accept_pages": payload_accept_pages,
    "payload_accept_documents": payload_accept_documents, "ingest_envelope": ingest_envelope, "response_counters": response_counters,
    "endpoint_normalise": endpoint_normalise, "endpoint_branches": endpoint_branches, "variant_targets": variant_targets,
    "post_outcomes": post_outcomes, "outcome_totals": outcome_totals, "summary_line": line_of_summary, "empty_batch": empty_batch,
}


def _address_sql(e: str, query: str) -> str:
    return f"CASE WHEN ends_with({e}, '/relay-ingest') THEN {e} WHEN ends_with({e}, '/scheduler') THEN {e} || '?action={query}' ELSE regexp_replace({e}, '/+$', '') || '/api/public/relay-ingest' END"


def _addresses_sql(e: str) -> str:
    return f"{_address_sql(e, 'relay-targets')} AS discovery_url, {_address_sql(e, 'relay-ingest')} AS ingest_url"


def _list_sql(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


_ABLE = "coalesce(page_id <> 0 AND url <> '', false)"
_OUTCOMES = f"""
o AS (SELECT {_ABLE} AS eligible, page_id % 7 <> 0 AND strpos(html, '<') > 0 AS fetched, coalesce(event_type <> 'error', false) AS answered,
             CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
      FROM pages LEFT JOIN events ON page_id = event_id)"""
_TOTALS = """count(*) AS discovered, count(*) FILTER ({0}) AS eligible, CAST(coalesce(sum(k) FILTER ({0} AND fetched AND answered), 0) AS BIGINT) AS total_synced,
CAST(0 AS BIGINT) AS total_added, count(*) FILTER ({0} AND NOT (fetched AND answered)) AS failed_count"""
_SUMMARY = f"WITH {_OUTCOMES} SELECT {_TOTALS.format('eligible')} FROM o"
_TRUE = """CASE json_type({0}) WHEN 'NULL' THEN false WHEN 'BOOLEAN' THEN {0} = 'true' WHEN 'VARCHAR' THEN json_extract_string({0}, '$') <> '' WHEN 'ARRAY' THEN json_array_length({0}) > 0
WHEN 'OBJECT' THEN len(json_keys({0})) > 0 ELSE CAST({0} AS DOUBLE) <> 0 END"""
_COUNT = """CASE WHEN json_type(b) <> 'OBJECT' THEN NULL WHEN NOT json_exists(b, '$.{0}') THEN 0 WHEN json_type(b, '$.{0}') IN ('UBIGINT', 'BIGINT') THEN CAST(json_extract_string(b, '$.{0}') AS BIGINT)
WHEN json_type(b, '$.{0}') = 'BOOLEAN' THEN CASE WHEN json_extract_string(b, '$.{0}') = 'true' THEN 1 ELSE 0 END END"""

ORACLE_SQL = {
    "relay_summary": _SUMMARY,
    "targets_scan": "SELECT page_id AS feed_id, url AS feed_url FROM pages",
    "targets_discovered": "SELECT count(*) AS discovered FROM pages",
    "targets_eligible": f"SELECT page_id AS feed_id, url AS feed_url FROM pages WHERE {_ABLE}",
    "targets_skipped": f"SELECT page_id AS feed_id, url AS feed_url FROM pages WHERE NOT {_ABLE}",
    "payload_accept_pages": "SELECT page_id, coalesce(strpos(html, '<') > 0, false) AS accepted FROM pages",
    "payload_accept_documents": "SELECT doc_id, coalesce(strpos(text, '<') > 0, false) AS accepted FROM documents",
    "ingest_envelope": "SELECT page_id, CAST(to_json({relay_results: [{feed_id: page_id, xml: html}]}) AS VARCHAR) AS envelope FROM pages",
    "response_counters": f"SELECT event_id, CAST({_COUNT.format('k')} AS BIGINT) AS processed, CAST({_COUNT.format('added')} AS BIGINT) AS added FROM (SELECT event_id, CAST(props AS JSON) AS b FROM events)",
    "endpoint_normalise": f"SELECT page_id, {_addresses_sql('url')} FROM pages",
    "endpoint_branches": f"""
WITH e AS (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/]+') || {_list_sql(ENDS)}[page_id % {len(ENDS)} + 1] AS endpoint FROM pages)
SELECT page_id, endpoint, {_addresses_sql('endpoint')} FROM e""",
    "variant_targets": f"""
WITH p AS (SELECT page_id, page_id // {LISTED} AS list, '{{"id":' || replace({_list_sql(IDS)}[page_id % {len(IDS)} + 1], '#', CAST(page_id AS VARCHAR)) || ',"feed_url":' ||
           replace({_list_sql(URLS)}[page_id % {len(URLS)} + 1], '@', '"' || url || '"') || '}}' AS t FROM pages WHERE page_id IS NOT NULL AND url IS NOT NULL),
l AS (SELECT CAST(list AS INT) AS list, CAST(CASE WHEN list % 5 = 4 THEN {_list_sql(BARE)}[list % {len(BARE)} + 1] ELSE '{{"targets":[' || string_agg(t, ',' ORDER BY page_id) || ']}}' END AS JSON) AS b FROM p GROUP BY list),
t AS (SELECT list, CAST(o AS INT) AS ord, b -> ('$.targets[' || o || ']') AS t
      FROM (SELECT list, b, unnest(range(CASE WHEN json_type(b, '$.targets') = 'ARRAY' THEN CAST(json_array_length(b, '$.targets') AS BIGINT) ELSE 0 END)) AS o FROM l)),
f AS (SELECT list, ord, t -> '$.id' AS i, t -> '$.feed_url' AS u FROM t),
e AS (SELECT *, coalesce({_TRUE.format('i')}, false) AND coalesce({_TRUE.format('u')}, false) AS eligible FROM f)
SELECT list, ord, CASE WHEN eligible THEN CAST(i AS VARCHAR) END AS feed_id, eligible FROM e""",
    "post_outcomes": f"""
WITH a AS (SELECT event_id, coalesce(event_type NOT IN ('error', 'signup'), true) AS good, replace({_list_sql(ANSWERS)}[event_id % {len(ANSWERS)} + 1], '#', json_extract_string(props, '$.k')) AS t FROM events),
j AS (SELECT event_id, CASE WHEN good AND json_valid(t) THEN CAST(t AS JSON) END AS b FROM a),
c AS (SELECT event_id, {_COUNT.format('processed')} AS p, {_COUNT.format('added')} AS q FROM j)
SELECT event_id, coalesce(p, 0) AS synced_inc, CASE WHEN p IS NOT NULL AND q IS NOT NULL THEN q ELSE 0 END AS added_inc, CAST(CASE WHEN p IS NULL OR q IS NULL THEN 1 ELSE 0 END AS BIGINT) AS failed_inc FROM c""",
    "outcome_totals": f"""
WITH {_OUTCOMES} SELECT CASE WHEN NOT eligible THEN 'skipped' WHEN NOT fetched THEN 'fetch_failed' WHEN NOT answered THEN 'post_failed' ELSE 'delivered' END AS outcome,
count(*) AS targets, CAST(coalesce(sum(k) FILTER (eligible AND fetched AND answered), 0) AS BIGINT) AS synced FROM o GROUP BY 1""",
    "summary_line": f"SELECT '[INFO] Batch sync complete: ' || total_synced || ' targets processed, ' || total_added || ' entries added, ' || failed_count || ' errors.' AS line FROM ({_SUMMARY})",
    "empty_batch": f"WITH {_OUTCOMES} SELECT {_TOTALS.format('false')} FROM o",
}
