"""Driver queries of the work between tables: corrections by field, links to
events of many kinds, chains and closures of references, validity windows."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import chains, corrections, derive, sequence


def table(spark, d, name) -> DataFrame:
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


# R12 ---------------------------------------------------------------------
#: fields and their range rules, as in a local concept registry
EVENT_RULES = [("value", '{"min": 5, "max": 150}'), ("user_id", '{"max": 90}'), ("event_type", None)]


def overlay_fields(spark, d):
    """Two fields of every event held against rules from JSON; a third of the
    red rows corrected (half of those with an error that stands), the rest
    open; all applied to the events."""
    ev = table(spark, d, "events").select("event_id", "user_id", "value")
    rules = corrections.field_ranges(spark.createDataFrame(EVENT_RULES, "source_field_name string, source_field_range string"))
    red = corrections.red_rows(ev, ["event_id"], ["value", "user_id"], rules)
    seen = F.col("event_id") % 3 == 0
    red = red.withColumns({"new_value": F.when(seen, F.when(F.col("field_name") == "value", "99.5").otherwise("7")),
                           "new_error": F.when(seen & (F.col("event_id") % 2 == 0), "entered by hand"), "status": seen.cast("int")})
    return corrections.overlay_fields(ev, red, ["event_id"], ["value", "user_id"])


# R11 ---------------------------------------------------------------------
def canonical_checksums(spark, d):
    """Event documents in three spellings (key order, blanks, numbers), one
    row per distinct value."""
    ev = table(spark, d, "events").select("event_id", "user_id", F.get_json_object("props", "$.k").alias("k"))
    user = F.col("user_id").cast("string")
    spelled = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit('{"k":'), "k", F.lit(',"user":"'), user, F.lit('"}'))) \
        .when(F.col("event_id") % 3 == 1, F.concat(F.lit('{ "user" : "'), user, F.lit('", "k": '), "k", F.lit(".0 }"))) \
        .otherwise(F.concat(F.lit('{"user":"'), user, F.lit('","k":'), "k", F.lit("e0}")))
    return derive.dedupe_by_checksum(ev.select("event_id", spelled.alias("data")), "data", "event_id", canonical=True)


# R15 ---------------------------------------------------------------------
ORDER_FIELD, EVENT_FIELD, PART_FIELD = 1147127, 1147330, 1147082


def episode_links(spark, d):
    """An episode per customer, linked to orders, events and parts (some of
    which do not exist), all resolved in one join."""
    orders, ev, part = table(spark, d, "orders"), table(spark, d, "events"), table(spark, d, "part")
    cust = table(spark, d, "customer").select(F.col("c_custkey").alias("episode_id"), "c_mktsegment")

    def link(df, episode, event, field):
        return df.select(F.col(episode).alias("episode_id"), F.expr(event).alias("event_id"), F.lit(field).alias("episode_event_field_concept_id"))
    links = (link(orders, "o_custkey", "o_orderkey", ORDER_FIELD).unionByName(link(ev, "user_id", "event_id", EVENT_FIELD))
             .unionByName(link(cust, "episode_id", "episode_id * 2", PART_FIELD)))
    directory = derive.event_directory({
        ORDER_FIELD: ("orders", orders.withColumn("day", F.to_date("o_orderdate")), "o_orderkey", {"day": "day", "kind": "o_orderstatus"}),
        EVENT_FIELD: ("events", ev.withColumn("day", F.to_date("ts")), "event_id", {"day": "day", "kind": "event_type"}),
        PART_FIELD: ("part", part.withColumn("day", F.lit(None).cast("date")), "p_partkey", {"day": "day", "kind": "p_type"})})
    out = derive.link_episode_events(links, directory, cust)
    return out.select("episode_id", "event_id", "event_table", F.col("day").alias("event_date"), "kind", "c_mktsegment")


# R7 ----------------------------------------------------------------------
REPLACED_BY = "Concept replaced by"


def concept_chains(spark, d):
    """Parts replaced by the next one, in chains of up to 49 hops, some of
    which run into cycles; every part with what it ends at."""
    k = F.col("p_partkey")
    edges = table(spark, d, "part").select(
        k.alias("concept_id_1"), F.when(k % 97 == 0, F.greatest(k - 5, F.lit(0))).when(k % 50 != 0, k + 1).alias("concept_id_2"),
        F.lit(REPLACED_BY).alias("relationship_id"), F.lit(None).cast("string").alias("invalid_reason"))
    valid = derive.related(edges, REPLACED_BY)
    known = table(spark, d, "part").select(F.col("p_partkey").alias("_known"))
    return chains.follow(valid.join(known, F.col("concept_id_2") == F.col("_known"), "left_semi"), "concept_id_1", "concept_id_2")


# J3 J4 -------------------------------------------------------------------
def visit_roots(spark, d):
    """Every event with the first of its user's chain of preceding events and
    how far back that is."""
    ev = table(spark, d, "events").select("event_id", "user_id", "ts")
    preceding = sequence.previous_in_order(ev, ["user_id"], ["ts", "event_id"], {"preceding_id": "event_id"})
    return chains.follow(preceding, "event_id", "preceding_id").select(F.col("node").alias("event_id"), F.col("root").alias("first_id"), "depth")


# R6 ----------------------------------------------------------------------
def concept_closure(spark, d):
    """The ancestor table of order -> customer -> nation -> region -> world,
    with short cuts, and the customers below every node at its least level."""
    n = table(spark, d, "nation")

    def edge(df, child, parent):
        return df.select(F.expr(child).alias("child"), F.expr(parent).alias("parent"))
    edges = (edge(n, "concat('n', n_nationkey)", "concat('r', n_regionkey)").unionByName(edge(n, "concat('r', n_regionkey)", "'world'"))
             .unionByName(edge(n.where("n_nationkey % 3 = 0"), "concat('n', n_nationkey)", "'world'"))
             .unionByName(edge(table(spark, d, "customer"), "concat('c', c_custkey)", "concat('n', c_nationkey)"))
             .unionByName(edge(table(spark, d, "orders"), "concat('o', o_orderkey)", "concat('c', o_custkey)"))
             .unionByName(edge(table(spark, d, "orders").where("o_orderstatus = 'P'"), "concat('o', o_orderkey)", "'world'")))
    return chains.closure(edges, "child", "parent")


# R4 ----------------------------------------------------------------------
def mapping_overlaps(spark, d):
    """A mapping per order, valid for a week from its date, by priority: those
    that begin before an earlier one has ended."""
    o = table(spark, d, "orders").select(F.col("o_orderpriority").alias("source_code"), F.col("o_orderkey").alias("target_concept_id"),
                                         F.to_date("o_orderdate").alias("valid_start_date"))
    return derive.overlapping_mappings(o.withColumn("valid_end_date", F.date_add("valid_start_date", F.lit(6))))


def mapping_hot_code(spark, d):
    """Line items mapped by a code that is the same for most of them."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("day"),
                                            F.when(F.col("l_quantity") > 10, "common").otherwise(F.col("l_returnflag")).alias("code"))
    codes = li.select(F.col("code").alias("source_code")).distinct()
    start = F.explode(F.sequence(F.lit("1995-01-01").cast("date"), F.lit("2001-06-01").cast("date"), F.expr("interval 3 months")))
    mapping = codes.select("source_code", start.alias("valid_start_date")).select(
        "*", F.date_add("valid_start_date", F.lit(80)).alias("valid_end_date"),
        F.concat("source_code", F.lit(" "), F.col("valid_start_date").cast("string")).alias("target_concept_id"))
    return derive.map_source_codes(li, mapping, "code", "day").groupBy("target_concept_id").agg(F.count(F.lit(1)).alias("n"))


# R14 ---------------------------------------------------------------------
def exposure_eras(spark, d):
    """Exposures of a week to two months per part, merged where they overlap,
    lie inside one another or are 30 days apart at most."""
    li = table(spark, d, "lineitem").select("l_partkey", F.to_date("l_shipdate").alias("start"),
                                            F.when(F.col("l_linenumber") != 7, F.date_add(F.to_date("l_shipdate"), F.col("l_quantity").cast("int") + 7)).alias("end"))
    return sequence.interval_eras(li, ["l_partkey"], "start", "end", 30, gap_col="gap_days")


QUERIES = {f.__name__: f for f in (overlay_fields, canonical_checksums, episode_links, concept_chains, visit_roots, concept_closure,
                                   mapping_overlaps, mapping_hot_code, exposure_eras)}


def _red(field, low, high):
    bounds = [f"WHEN {field} < {low} THEN 'below {float(low)}'"] if low is not None else []
    return "CASE " + " ".join([*bounds, f"WHEN {field} > {high} THEN 'above {float(high)}'"]) + " END"


ORACLE_SQL = {
    "overlay_fields": (
        f"WITH e AS (SELECT event_id, user_id, value, {_red('value', 5, 150)} AS ev, {_red('user_id', None, 90)} AS eu, "
        "event_id % 3 = 0 AS seen, CASE WHEN event_id % 2 = 0 THEN 'entered by hand' END AS hand FROM events) "
        "SELECT event_id, CASE WHEN eu IS NOT NULL AND seen THEN 7 ELSE user_id END AS user_id, "
        "CASE WHEN ev IS NOT NULL AND seen THEN 99.5 ELSE value END AS value, "
        "CASE WHEN ev IS NOT NULL THEN CASE WHEN seen THEN hand ELSE ev END END AS value_error, "
        "CASE WHEN ev IS NOT NULL THEN seen::INT END AS value_status, "
        "CASE WHEN eu IS NOT NULL THEN CASE WHEN seen THEN hand ELSE eu END END AS user_id_error, "
        "CASE WHEN eu IS NOT NULL THEN seen::INT END AS user_id_status FROM e"),
    "canonical_checksums": "SELECT min(event_id) AS event_id, sha256('{\"k\":' || k || ',\"user\":\"' || user_id || '\"}') AS checksum "
                           "FROM (SELECT event_id, user_id, json_extract_string(props, '$.k') AS k FROM events) GROUP BY k, user_id",
    "episode_links": (
        "WITH l AS (SELECT o_custkey AS e, o_orderkey AS v, 'orders' AS t FROM orders UNION ALL SELECT user_id, event_id, 'events' FROM events "
        "UNION ALL SELECT c_custkey, c_custkey * 2, 'part' FROM customer), "
        "x AS (SELECT 'orders' AS t, o_orderkey AS v, o_orderdate::DATE AS day, o_orderstatus AS kind FROM orders "
        "UNION ALL SELECT 'events', event_id, ts::DATE, event_type FROM events UNION ALL SELECT 'part', p_partkey, NULL, p_type FROM part) "
        "SELECT e AS episode_id, l.v AS event_id, x.t AS event_table, day AS event_date, kind, c_mktsegment "
        "FROM l LEFT JOIN x ON x.t = l.t AND x.v = l.v LEFT JOIN customer ON c_custkey = e"),
    "concept_chains": (
        "WITH RECURSIVE e AS (SELECT a, b FROM (SELECT p_partkey AS a, CASE WHEN p_partkey % 97 = 0 THEN greatest(p_partkey - 5, 0) "
        "WHEN p_partkey % 50 <> 0 THEN p_partkey + 1 END AS b FROM part) WHERE b IN (SELECT p_partkey FROM part)), "
        "r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b), "
        "n AS (SELECT a AS node FROM e UNION SELECT b FROM e), l AS (SELECT a FROM r WHERE a = b), "
        "c AS (SELECT a, min(b) AS cycle FROM r WHERE b IN (SELECT a FROM l) GROUP BY a) "
        "SELECT node, CASE WHEN cycle IS NULL THEN coalesce((SELECT max(b) FROM r WHERE r.a = node AND b NOT IN (SELECT a FROM e)), node) END AS root, "
        "CASE WHEN cycle IS NULL THEN (SELECT count(*) FROM r WHERE r.a = node) END AS depth, cycle, "
        "node IN (SELECT a FROM l) AS on_cycle FROM n LEFT JOIN c ON c.a = node"),
    "visit_roots": "SELECT event_id, first_value(event_id) OVER w AS first_id, row_number() OVER w - 1 AS depth FROM events "
                   "WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)",
    "concept_closure": (
        "WITH RECURSIVE e AS (SELECT DISTINCT * FROM (SELECT 'n' || n_nationkey AS d, 'r' || n_regionkey AS a FROM nation "
        "UNION ALL SELECT 'r' || n_regionkey, 'world' FROM nation UNION ALL SELECT 'n' || n_nationkey, 'world' FROM nation WHERE n_nationkey % 3 = 0 "
        "UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey FROM customer UNION ALL SELECT 'o' || o_orderkey, 'c' || o_custkey FROM orders "
        "UNION ALL SELECT 'o' || o_orderkey, 'world' FROM orders WHERE o_orderstatus = 'P')), "
        "p(d, a, k) AS (SELECT d, a, 1 FROM e UNION ALL SELECT p.d, e.a, k + 1 FROM p JOIN e ON e.d = p.a) "
        "SELECT a AS ancestor_concept_id, d AS descendant_concept_id, min(k) AS min_levels_of_separation, max(k) AS max_levels_of_separation "
        "FROM (SELECT * FROM p UNION ALL SELECT n, n, 0 FROM (SELECT d AS n FROM e UNION SELECT a FROM e)) GROUP BY 1, 2"),
    "mapping_overlaps": (
        "SELECT * FROM (SELECT *, max(valid_end_date) OVER (PARTITION BY source_code ORDER BY valid_start_date, valid_end_date, target_concept_id "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS covered_until FROM (SELECT o_orderpriority AS source_code, "
        "o_orderkey AS target_concept_id, o_orderdate::DATE AS valid_start_date, (o_orderdate::DATE + 6)::DATE AS valid_end_date FROM orders)) "
        "WHERE valid_start_date <= covered_until"),
    "mapping_hot_code": (
        "WITH l AS (SELECT CASE WHEN l_quantity > 10 THEN 'common' ELSE l_returnflag END AS code, l_shipdate::DATE AS day FROM lineitem), "
        "m AS (SELECT DISTINCT code, s::DATE AS s, (s::DATE + 80)::DATE AS e FROM l, "
        "generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-06-01', INTERVAL 3 MONTH) g(s)) "
        "SELECT m.code || ' ' || s::VARCHAR AS target_concept_id, count(*) AS n FROM l LEFT JOIN m ON m.code = l.code AND day BETWEEN s AND e GROUP BY 1"),
    "exposure_eras": (
        "WITH x AS (SELECT l_partkey, l_shipdate::DATE AS s, CASE WHEN l_linenumber <> 7 THEN (l_shipdate::DATE + (l_quantity::INT + 7))::DATE "
        "ELSE l_shipdate::DATE END AS e, count(*) AS n FROM lineitem GROUP BY ALL), "
        "r AS (SELECT *, max(e) OVER (PARTITION BY l_partkey ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM x), "
        "f AS (SELECT *, CASE WHEN s - reach <= 30 THEN 0 ELSE 1 END AS brk, CASE WHEN s - reach BETWEEN 2 AND 30 THEN s - reach - 1 ELSE 0 END AS gap FROM r), "
        "i AS (SELECT *, sum(brk) OVER (PARTITION BY l_partkey ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS era FROM f) "
        "SELECT l_partkey, min(s) AS era_start, max(e) AS era_end, sum(n)::BIGINT AS n, sum(gap)::BIGINT AS gap_days FROM i GROUP BY l_partkey, era"),
}
