"""Queries over the driver's test tables, one per operator family.

Every query reads whole tables and goes through the library's operators;
``ORACLE_SQL`` holds the DuckDB statement computing the same rows.  Names of
output columns match between the two.
"""
from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contracts
from ..functions import coerce
from ..functions.variant import json_field
from ..operators import checks, codebook, derive, navigate, sequence
from ..session import scratch_path
from ..sinks.warehouse import upsert_frames
from ..sources.vocab import read_vocab_file
from . import clinical_queries, load_queries


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# S1 S2 F6 ----------------------------------------------------------------
NATION = contracts.ad_hoc("nation", "n_nationkey int!, n_name vc25!, n_regionkey int!",
                          pk="n_nationkey")


def scan_tsv_nation(spark, d):
    """Write nation in the vocabulary dialect (tab, backspace quote, upper-case
    header in another column order), then load it back by header name."""
    src = table(spark, d, "nation")
    out = scratch_path(spark, "nation-tsv")
    (src.select(F.col("n_name").alias("N_NAME"), F.col("n_regionkey").cast("string").alias("N_REGIONKEY"),
                F.col("n_nationkey").cast("string").alias("N_NATIONKEY"))
        .write.option("sep", "\t").option("quote", "\b").option("escape", "\b")
        .option("header", "true").csv(out))
    return read_vocab_file(spark, out, NATION)


# S4 F4 -------------------------------------------------------------------
def null_tokens_orders(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", coerce.null_tokens(F.col("o_orderpriority"),
                                                     ["5-LOW", "4-NOT SPECIFIED"]).alias("priority"))


# F2 ----------------------------------------------------------------------
def coerce_int_lineitem(spark, d):
    li = table(spark, d, "lineitem")
    value, error = coerce.to_int(F.col("l_extendedprice").cast("string"))
    return li.select("l_orderkey", "l_linenumber", coerce.strict(value, error).alias("price_int"))


# F1 ----------------------------------------------------------------------
def coerce_bool_events(spark, d):
    ev = table(spark, d, "events")
    token = (F.when(F.col("event_type") == "click", "YES").when(F.col("event_type") == "view", "f")
              .when(F.col("event_type") == "purchase", "1").when(F.col("event_type") == "signup", "no"))
    value, error = coerce.to_bool(token)
    return ev.select("event_id", coerce.strict(value, error).alias("flag"))


# F5 F9 F10 ---------------------------------------------------------------
def json_field_events(spark, d):
    ev = table(spark, d, "events")
    doc, _ = coerce.to_json_value(F.col("props"))
    return ev.select("event_id", json_field(doc, "$.k", "int").alias("k"))


# C1 ----------------------------------------------------------------------
def pk_violations_lineitem(spark, d):
    return checks.duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


# C2 J5 -------------------------------------------------------------------
def fk_violations_documents(spark, d):
    rows = checks.fk_violation_rows(table(spark, d, "documents"), table(spark, d, "labels"),
                                    ["doc_id"], ["doc_id"])
    return rows.select("doc_id")


# C3 A2 -------------------------------------------------------------------
def unique_violations_documents(spark, d):
    return checks.duplicate_keys(table(spark, d, "documents"), ["text"], skip_nulls=True)


# C5 ----------------------------------------------------------------------
def length_violations_documents(spark, d):
    return checks.length_violation_rows(table(spark, d, "documents"), "text", 1000, keep=["doc_id"])


# C4 ----------------------------------------------------------------------
def not_null_violations_labels(spark, d):
    joined = navigate.many_to_one(table(spark, d, "documents").select("doc_id"),
                                  table(spark, d, "labels"), "doc_id", "doc_id", ["quality"])
    return checks.not_null_violation_rows(joined, ["quality"]).select("doc_id")


# C4 C5 report ------------------------------------------------------------
DOCUMENTS = contracts.ad_hoc("documents", "doc_id bigint!, text vc1000, lang vc2!, source vc20, n_chars bigint!",
                             pk="doc_id")


def column_checks_documents(spark, d):
    docs = table(spark, d, "documents").select(
        "doc_id", "text", "lang", "source", "n_chars")
    return checks.column_report(docs, DOCUMENTS)


# C1 C3 C2 report ---------------------------------------------------------
def key_checks_lineitem(spark, d):
    li = table(spark, d, "lineitem")
    lc = contracts.ad_hoc("lineitem", "l_orderkey bigint!, l_partkey bigint!, l_suppkey bigint!, "
                                      "l_linenumber int!", pk="l_orderkey, l_linenumber")
    fk = checks.fk_report({"lineitem": li, "orders": table(spark, d, "orders")},
                          table(spark, d, "orders"), "o_orderkey", {"lineitem": ["l_orderkey"]}, "orders")
    return checks.pk_report(li, lc).unionByName(fk)


# C6 ----------------------------------------------------------------------
# Contracts for the driver's star schema, in the library's notation.
STAR = {
    "region": contracts.ad_hoc("region", "r_regionkey int!, r_name vc25!", pk="r_regionkey"),
    "nation": contracts.ad_hoc("nation", "n_nationkey int!, n_name vc25!, n_regionkey int!", pk="n_nationkey",
                               fks=["n_regionkey -> x.region.r_regionkey"]),
    "supplier": contracts.ad_hoc("supplier", "s_suppkey bigint!, s_name vc25!, s_nationkey int!",
                                 pk="s_suppkey", fks=["s_nationkey -> x.nation.n_nationkey"]),
    "customer": contracts.ad_hoc("customer", "c_custkey bigint!, c_name vc25!, c_nationkey int!, "
                                 "c_mktsegment vc10", pk="c_custkey",
                                 fks=["c_nationkey -> x.nation.n_nationkey"]),
    "part": contracts.ad_hoc("part", "p_partkey bigint!, p_name vc10!, p_brand vc10", pk="p_partkey"),
    "orders": contracts.ad_hoc("orders", "o_orderkey bigint!, o_custkey bigint!, o_orderpriority vc15",
                               pk="o_orderkey", fks=["o_custkey -> x.customer.c_custkey"]),
    "lineitem": contracts.ad_hoc("lineitem", "l_orderkey bigint!, l_partkey bigint!, l_suppkey bigint!, "
                                 "l_linenumber int!", pk="l_orderkey, l_linenumber",
                                 fks=["l_orderkey -> x.orders.o_orderkey", "l_partkey -> x.part.p_partkey",
                                      "l_suppkey -> x.supplier.s_suppkey"]),
}


def validate_star(spark, d):
    """Every declared check over the star schema in one report: keys, column
    checks, and foreign keys stacked per parent (customer and supplier share
    one anti-join against nation)."""
    frames = {t: table(spark, d, t).select(*c.column_names) for t, c in STAR.items()}
    return checks.validate_tables(frames, STAR)


def _star_oracle() -> str:
    parts = []
    for t, c in STAR.items():
        pk = list(c.primary_key)
        key = "to_json(struct_pack(" + ", ".join(f"{k} := {k}" for k in pk) + "))"
        nn = " AND ".join(f"{k} IS NOT NULL" for k in pk)
        anynull = " OR ".join(f"{k} IS NULL" for k in pk)
        parts.append(f"SELECT '{t}' AS table_name, 'primary_key' AS constraint_name, '{','.join(pk)}' AS columns, "
                     f"CAST({key} AS VARCHAR) AS key, count(*) AS n FROM {t} WHERE {nn} "
                     f"GROUP BY {', '.join(pk)} HAVING count(*) > 1")
        if any(c.column(k).nullable for k in pk):  # else the NOT NULL checks below cover it
            parts.append(f"SELECT '{t}', 'primary_key_null', '{','.join(pk)}', NULL, count(*) FROM {t} "
                         f"WHERE {anynull} HAVING count(*) > 0")
        for col in c.columns:
            if not col.nullable:
                parts.append(f"SELECT '{t}', 'not_null', '{col.name}', NULL, count(*) FROM {t} "
                             f"WHERE {col.name} IS NULL HAVING count(*) > 0")
            if col.kind == "vc":
                parts.append(f"SELECT '{t}', 'max_length_{col.length}', '{col.name}', NULL, count(*) FROM {t} "
                             f"WHERE length({col.name}) > {col.length} HAVING count(*) > 0")
        for fk in c.foreign_keys:
            f, r, rc = fk.columns[0], fk.ref_table, fk.ref_columns[0]
            parts.append(f"SELECT '{t}', 'foreign_key:{r}.{rc}', '{f}', CAST({f} AS VARCHAR), count(*) FROM {t} "
                         f"WHERE {f} IS NOT NULL AND {f} NOT IN (SELECT {rc} FROM {r} WHERE {rc} IS NOT NULL) "
                         f"GROUP BY {f}")
    return " UNION ALL ".join(parts)


# R5 ----------------------------------------------------------------------
# A field registry in the shape of local_concept rows (cohort, field, concept, target table).
PART_FIELDS = [(1, "p_brand", 2000000101, "observation", True),
               (1, "p_type", 2000000102, "observation", True),
               (1, "p_size", 2000000103, "measurement", True)]


def route_part_fields(spark, d):
    """Wide records unpivoted to one row per field, each routed to its
    registered concept and target table."""
    wide = table(spark, d, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    registry = spark.createDataFrame(PART_FIELDS, "cohort int, source_field_name string, concept_id int, "
                                                   "table string, is_active boolean")
    return derive.route_fields(wide, registry, ["p_partkey"], 1)


# K3 J6 -------------------------------------------------------------------
def upsert_customer(spark, d):
    """The whole customer table split by segment: the target lacks the
    AUTOMOBILE rows, the source brings AUTOMOBILE (inserts) and BUILDING
    (updates, balance + 1); the other segments stay untouched."""
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    target = c.where(F.col("c_mktsegment") != "AUTOMOBILE").drop("c_mktsegment")
    source = (c.where(F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING"))
               .select("c_custkey", "c_name", (F.col("c_acctbal") + 1).alias("c_acctbal")))
    return upsert_frames(target, source, "c_custkey", ["c_name", "c_acctbal"], preserve=(), touch=None)


# K2 ----------------------------------------------------------------------
def replace_restart_identity(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_name")
    return sequence.assign_ids(p, ["p_partkey"], "id").select("id", "p_name")


# J1 ----------------------------------------------------------------------
def nav_many_to_one(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return navigate.path(li, [
        (table(spark, d, "orders"), "l_orderkey", "o_orderkey", ["o_custkey"]),
        (table(spark, d, "customer"), "o_custkey", "c_custkey", ["c_nationkey"]),
    ]).select("l_orderkey", "l_linenumber", "o_custkey", "c_nationkey")


# J2 ----------------------------------------------------------------------
def nav_one_to_many(spark, d):
    return navigate.child_counts(table(spark, d, "documents").select("doc_id"),
                                 table(spark, d, "labels"), "doc_id", "doc_id", "n_children")


# J3 ----------------------------------------------------------------------
def nav_self_reference(spark, d):
    ev = table(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    chained = sequence.previous_in_order(ev, ["user_id"], ["ts", "event_id"], {"preceding_id": "event_id"})
    # the referenced side is the stored table, not the derived chain
    nav = navigate.self_many_to_one(chained, "preceding_id", "event_id", ["event_type"], "preceding_",
                                    parent=ev)
    return nav.select("event_id", "preceding_id", F.col("preceding_event_type").alias("preceding_type"))


# J7 ----------------------------------------------------------------------
def cascade_delete(spark, d):
    docs = table(spark, d, "documents").where(F.col("lang") == "en")
    return navigate.following_rows(table(spark, d, "labels"), docs, "doc_id", "doc_id") \
                   .select("doc_id", "quality", "toxic")


# R2 ----------------------------------------------------------------------
def cohort_union(spark, d):
    """Every market segment as a cohort."""
    c = table(spark, d, "customer")
    segments = [r[0] for r in c.select("c_mktsegment").distinct().collect()]  # cohorts are schemas: a registry
    return derive.union_cohorts({f"cohort_{s.lower()}": c.where(F.col("c_mktsegment") == s).select("c_custkey")
                                 for s in segments})


# A2 A3 -------------------------------------------------------------------
def codebook_duplicates(spark, d):
    items = table(spark, d, "part").select(F.col("p_name").alias("name"), F.col("p_brand").alias("codebook"))
    return codebook.duplicate_names(items)


# R6 ----------------------------------------------------------------------
def concept_rollup(spark, d):
    by_region = derive.rollup(table(spark, d, "customer"), "c_nationkey", table(spark, d, "nation"),
                              "n_nationkey", "n_regionkey", out_ancestor="r_regionkey")
    named = navigate.many_to_one(by_region, table(spark, d, "region"), "r_regionkey", "r_regionkey",
                                 ["r_name"])
    return named.groupBy(F.col("r_name").alias("ancestor")).agg(F.sum("n").alias("n"))


def lineitems_per_nation(spark, d):
    """R6 along a chain: lineitem counts rolled up order -> customer -> nation,
    aggregating before every join so each join sees one row per key."""
    per_cust = derive.rollup(table(spark, d, "lineitem"), "l_orderkey", table(spark, d, "orders"),
                             "o_orderkey", "o_custkey", out_ancestor="c_custkey")
    per_nation = derive.rollup(per_cust, "c_custkey", table(spark, d, "customer"), "c_custkey",
                               "c_nationkey", out_ancestor="n_nationkey", weight="n")
    named = navigate.many_to_one(per_nation, table(spark, d, "nation"), "n_nationkey", "n_nationkey",
                                 ["n_name"])
    return named.groupBy(F.col("n_name").alias("nation")).agg(F.sum("n").alias("n"))


# R3 ----------------------------------------------------------------------
def enrich_lineitem_parts(spark, d):
    """Attribute lookup for key columns: the dimension is first cut to the
    keys the fact uses, then joined once per column."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    out = derive.enrich_concepts(li, table(spark, d, "part"), ["l_partkey"], take=("p_name",),
                                 concept_key="p_partkey")
    return out.withColumnRenamed("l_partkey__p_name", "part_name")


# R12 ---------------------------------------------------------------------
def overlay_events(spark, d):
    """Red-flag rows get a correction row (original and new value as text);
    the overlay applies ``coalesce(new_value, original_value)``."""
    ev = table(spark, d, "events").select("event_id", "value")
    red = ev.where(F.col("value") > 200).select(
        "event_id", F.col("value").cast("string").alias("original_value"),
        F.lit("200.0").alias("new_value"))
    return derive.overlay_corrections(ev, red, "event_id", "value")


# R15 ---------------------------------------------------------------------
ORDER_DOMAIN, PART_DOMAIN, CONTAINS = 1, 2, 3


def link_order_parts(spark, d):
    """Fact links in ``fact_relationship`` form (domain + id on each side),
    here derived from lineitem (order contains part), resolved to the facts
    on both sides with two equi-joins."""
    fr = table(spark, d, "lineitem").select(
        F.lit(ORDER_DOMAIN).alias("domain_concept_id_1"), F.col("l_orderkey").alias("fact_id_1"),
        F.lit(PART_DOMAIN).alias("domain_concept_id_2"), F.col("l_partkey").alias("fact_id_2"),
        F.lit(CONTAINS).alias("relationship_concept_id"))
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    part = table(spark, d, "part").select("p_partkey", "p_brand")
    linked = derive.link_facts(fr, orders, ORDER_DOMAIN, "o_orderkey", part, PART_DOMAIN, "p_partkey")
    return linked.select(F.col("fact_id_1").alias("o_orderkey"), F.col("fact_id_2").alias("p_partkey"),
                         "o_orderpriority", "p_brand")


# R4 ----------------------------------------------------------------------
def mapping_validity_join(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    years = F.explode(F.array(F.lit(1996), F.lit(1997)))
    codes = o.select(F.col("o_orderpriority").alias("source_code")).distinct()
    mapping = (codes.select("source_code", years.alias("y"))
                    .select("source_code", F.col("y").alias("target_concept_id"),
                            F.make_date("y", F.lit(1), F.lit(1)).alias("valid_start_date"),
                            F.make_date("y", F.lit(12), F.lit(31)).alias("valid_end_date")))
    out = derive.map_source_codes(o, mapping, "o_orderpriority", F.to_date("o_orderdate"),
                                  take=("target_concept_id",), valid_only=False)
    return out.select("o_orderkey", F.col("target_concept_id").alias("target_id"))


# R7 ----------------------------------------------------------------------
# Fixed values of the traversal query: the two relationship ids, the open
# end date of a valid edge and the reference date.
SUPPLIED_BY, SUPPLIES = "Supplied by", "Supplies"
OPEN_END = datetime.date(2099, 12, 31)
AS_OF = datetime.date(1998, 1, 1)


def supply_relationships(spark, d) -> DataFrame:
    """An edge table in the concept_relationship shape, both directions,
    from every lineitem: part 'Supplied by' supplier and supplier 'Supplies'
    part, valid from the ship date on; returned items are invalid edges."""
    li = table(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_shipdate", "l_returnflag")
    pair = F.explode(F.array(
        F.struct(F.col("l_partkey").alias("concept_id_1"), F.col("l_suppkey").alias("concept_id_2"),
                 F.lit(SUPPLIED_BY).alias("relationship_id")),
        F.struct(F.col("l_suppkey").alias("concept_id_1"), F.col("l_partkey").alias("concept_id_2"),
                 F.lit(SUPPLIES).alias("relationship_id"))))
    return li.select(pair.alias("e"), F.to_date("l_shipdate").alias("valid_start_date"),
                     F.lit(OPEN_END).alias("valid_end_date"),
                     F.when(F.col("l_returnflag") == "R", F.lit("D")).alias("invalid_reason")) \
             .select("e.*", "valid_start_date", "valid_end_date", "invalid_reason")


def relationship_traversal(spark, d):
    """Suppliers of each part valid on a date, found through the reverse
    of 'Supplies' (looked up in the relationship table, not hard-wired)."""
    relationship = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("relationship_id"), F.lit(b).alias("reverse_relationship_id"))
        for a, b in [(SUPPLIED_BY, SUPPLIES), (SUPPLIES, SUPPLIED_BY)]])))
    edges = derive.related(supply_relationships(spark, d), derive.reverse_of(relationship, SUPPLIES),
                           as_of=F.lit(AS_OF))
    return edges.groupBy(F.col("concept_id_1").alias("part_id")) \
                .agg(F.count_distinct("concept_id_2").alias("n_suppliers"))


# R10 ---------------------------------------------------------------------
def quarantine_split(spark, d):
    attributed = derive.attribute(table(spark, d, "documents").select("doc_id"),
                                  table(spark, d, "labels"), "doc_id")
    return derive.route_counts(attributed)


# R12 ---------------------------------------------------------------------
def red_overlay(spark, d):
    return derive.red_flags(table(spark, d, "events").select("event_id", "value"), "value", 0, 200)


# R11 ---------------------------------------------------------------------
def checksum_dedupe(spark, d):
    return derive.dedupe_by_checksum(table(spark, d, "documents"), "text", "doc_id")


# R14 ---------------------------------------------------------------------
def era_events(spark, d):
    ev = table(spark, d, "events")
    return sequence.eras(ev, ["user_id", "event_type"], F.to_date("ts"), 2)


# A1 ----------------------------------------------------------------------
def row_counts(spark, d):
    parts = [table(spark, d, t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("tbl"), "n")
             for t in ("orders", "lineitem")]
    return parts[0].unionByName(parts[1])


QUERIES = {
    **load_queries.QUERIES,
    **clinical_queries.QUERIES,
    "scan_tsv_nation": scan_tsv_nation,
    "null_tokens_orders": null_tokens_orders,
    "coerce_int_lineitem": coerce_int_lineitem,
    "coerce_bool_events": coerce_bool_events,
    "json_field_events": json_field_events,
    "pk_violations_lineitem": pk_violations_lineitem,
    "fk_violations_documents": fk_violations_documents,
    "unique_violations_documents": unique_violations_documents,
    "length_violations_documents": length_violations_documents,
    "not_null_violations_labels": not_null_violations_labels,
    "column_checks_documents": column_checks_documents,
    "key_checks_lineitem": key_checks_lineitem,
    "validate_star": validate_star,
    "route_part_fields": route_part_fields,
    "upsert_customer": upsert_customer,
    "replace_restart_identity": replace_restart_identity,
    "nav_many_to_one": nav_many_to_one,
    "nav_one_to_many": nav_one_to_many,
    "nav_self_reference": nav_self_reference,
    "cascade_delete": cascade_delete,
    "cohort_union": cohort_union,
    "codebook_duplicates": codebook_duplicates,
    "concept_rollup": concept_rollup,
    "lineitems_per_nation": lineitems_per_nation,
    "enrich_lineitem_parts": enrich_lineitem_parts,
    "overlay_events": overlay_events,
    "link_order_parts": link_order_parts,
    "mapping_validity_join": mapping_validity_join,
    "relationship_traversal": relationship_traversal,
    "quarantine_split": quarantine_split,
    "red_overlay": red_overlay,
    "checksum_dedupe": checksum_dedupe,
    "era_events": era_events,
    "row_counts": row_counts,
}

ORACLE_SQL = {
    **load_queries.ORACLE_SQL,
    **clinical_queries.ORACLE_SQL,
    "scan_tsv_nation": "SELECT n_nationkey, n_name, n_regionkey FROM nation",
    "null_tokens_orders": "SELECT o_orderkey, CASE WHEN o_orderpriority IN ('5-LOW','4-NOT SPECIFIED') "
                          "THEN NULL ELSE o_orderpriority END AS priority FROM orders",
    "coerce_int_lineitem": "SELECT l_orderkey, l_linenumber, CAST(trunc(l_extendedprice) AS INTEGER) AS price_int "
                           "FROM lineitem",
    "coerce_bool_events": "SELECT event_id, CASE event_type WHEN 'click' THEN TRUE WHEN 'view' THEN FALSE "
                          "WHEN 'purchase' THEN TRUE WHEN 'signup' THEN FALSE END AS flag FROM events",
    "json_field_events": "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
    "pk_violations_lineitem": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem "
                              "GROUP BY 1, 2 HAVING count(*) > 1",
    "fk_violations_documents": "SELECT doc_id FROM documents d WHERE doc_id IS NOT NULL AND NOT EXISTS "
                               "(SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
    "unique_violations_documents": "SELECT text, count(*) AS n FROM documents WHERE text IS NOT NULL "
                                   "GROUP BY text HAVING count(*) > 1",
    "length_violations_documents": "SELECT doc_id, CAST(length(text) AS INTEGER) AS len FROM documents "
                                   "WHERE length(text) > 1000",
    "not_null_violations_labels": "SELECT d.doc_id FROM documents d LEFT JOIN labels l USING (doc_id) "
                                  "WHERE l.quality IS NULL",
    "column_checks_documents": (
        "SELECT * FROM ("
        "SELECT 'documents' AS table_name, 'not_null' AS constraint_name, c AS columns, "
        "CAST(NULL AS VARCHAR) AS key, n FROM (SELECT 'doc_id' AS c, count(*) FILTER (WHERE doc_id IS NULL) AS n "
        "FROM documents UNION ALL SELECT 'lang', count(*) FILTER (WHERE lang IS NULL) FROM documents "
        "UNION ALL SELECT 'n_chars', count(*) FILTER (WHERE n_chars IS NULL) FROM documents) "
        "UNION ALL SELECT 'documents', 'max_length_' || CAST(m AS VARCHAR), c, CAST(NULL AS VARCHAR), n FROM ("
        "SELECT 'text' AS c, 1000 AS m, count(*) FILTER (WHERE length(text) > 1000) AS n FROM documents "
        "UNION ALL SELECT 'lang', 2, count(*) FILTER (WHERE length(lang) > 2) FROM documents "
        "UNION ALL SELECT 'source', 20, count(*) FILTER (WHERE length(source) > 20) FROM documents)"
        ") WHERE n > 0"),
    "key_checks_lineitem": (
        "SELECT 'lineitem' AS table_name, 'primary_key' AS constraint_name, 'l_orderkey,l_linenumber' AS columns, "
        "'{\"l_orderkey\":' || CAST(l_orderkey AS VARCHAR) || ',\"l_linenumber\":' || CAST(l_linenumber AS VARCHAR) || '}' "
        "AS key, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1 "
        "UNION ALL SELECT 'lineitem', 'primary_key_null', 'l_orderkey,l_linenumber', NULL, count(*) FROM lineitem "
        "WHERE l_orderkey IS NULL OR l_linenumber IS NULL HAVING count(*) > 0 "
        "UNION ALL SELECT 'lineitem', 'foreign_key:orders.o_orderkey', 'l_orderkey', CAST(l_orderkey AS VARCHAR), "
        "count(*) FROM lineitem l WHERE l_orderkey IS NOT NULL AND NOT EXISTS "
        "(SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey) GROUP BY l_orderkey"),
    "route_part_fields": (
        "SELECT p_partkey, f AS source_field_name, v AS value, r.concept_id, r.target_table FROM ("
        "SELECT p_partkey, 'p_brand' AS f, p_brand AS v FROM part UNION ALL "
        "SELECT p_partkey, 'p_type', p_type FROM part UNION ALL "
        "SELECT p_partkey, 'p_size', CAST(p_size AS VARCHAR) FROM part) u "
        "LEFT JOIN (VALUES ('p_brand', 2000000101, 'observation'), ('p_type', 2000000102, 'observation'), "
        "('p_size', 2000000103, 'measurement')) r(field, concept_id, target_table) ON u.f = r.field"),
    "upsert_customer": (
        "WITH t AS (SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment <> 'AUTOMOBILE'), "
        "s AS (SELECT c_custkey, c_name, c_acctbal + 1 AS c_acctbal FROM customer "
        "WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING')) "
        "SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey, "
        "CASE WHEN s.c_custkey IS NOT NULL THEN s.c_name ELSE t.c_name END AS c_name, "
        "CASE WHEN s.c_custkey IS NOT NULL THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal "
        "FROM t FULL JOIN s ON t.c_custkey = s.c_custkey"),
    "replace_restart_identity": "SELECT CAST(row_number() OVER (ORDER BY p_partkey) AS INTEGER) AS id, p_name FROM part",
    "nav_many_to_one": "SELECT l.l_orderkey, l.l_linenumber, o.o_custkey, c.c_nationkey FROM lineitem l "
                       "LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey "
                       "LEFT JOIN customer c ON o.o_custkey = c.c_custkey",
    "nav_one_to_many": "SELECT d.doc_id, count(l.doc_id) AS n_children FROM documents d "
                       "LEFT JOIN labels l USING (doc_id) GROUP BY d.doc_id",
    "nav_self_reference": (
        "WITH e AS (SELECT event_id, user_id, event_type, lag(event_id) OVER "
        "(PARTITION BY user_id ORDER BY ts, event_id) AS preceding_id FROM events) "
        "SELECT e.event_id, e.preceding_id, p.event_type AS preceding_type FROM e "
        "LEFT JOIN e p ON e.preceding_id = p.event_id"),
    "cascade_delete": "SELECT l.doc_id, l.quality, l.toxic FROM labels l WHERE EXISTS "
                      "(SELECT 1 FROM documents d WHERE d.doc_id = l.doc_id AND d.lang = 'en')",
    "cohort_union": "SELECT 'cohort_' || lower(c_mktsegment) AS cohort, c_custkey FROM customer WHERE c_mktsegment IS NOT NULL",
    "codebook_duplicates": "SELECT p_name AS name, count(*) AS n, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) "
                           "AS books FROM part GROUP BY p_name HAVING count(*) > 1",
    "concept_rollup": "SELECT r_name AS ancestor, count(*) AS n FROM customer "
                      "JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey "
                      "GROUP BY r_name",
    "lineitems_per_nation": "SELECT n_name AS nation, count(*) AS n FROM lineitem "
                            "JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey "
                            "JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name",
    "enrich_lineitem_parts": "SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, p.p_name AS part_name "
                             "FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey",
    "overlay_events": "SELECT event_id, CASE WHEN value > 200 THEN 200.0 ELSE value END AS value FROM events",
    "link_order_parts": "SELECT l.l_orderkey AS o_orderkey, l.l_partkey AS p_partkey, o.o_orderpriority, p.p_brand "
                        "FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey "
                        "JOIN part p ON l.l_partkey = p.p_partkey",
    "mapping_validity_join": (
        "WITH m AS (SELECT DISTINCT o_orderpriority AS source_code, y AS target_id, "
        "make_date(CAST(y AS BIGINT),1,1) AS vs, make_date(CAST(y AS BIGINT),12,31) AS ve "
        "FROM orders, (VALUES (1996),(1997)) v(y)) "
        "SELECT o.o_orderkey, m.target_id FROM orders o LEFT JOIN m ON o.o_orderpriority = m.source_code "
        "AND CAST(o.o_orderdate AS DATE) BETWEEN m.vs AND m.ve"),
    "relationship_traversal":
        "WITH e AS (SELECT l_partkey AS concept_id_1, l_suppkey AS concept_id_2, 'Supplied by' AS relationship_id, "
        "CAST(l_shipdate AS DATE) AS valid_start_date, DATE '2099-12-31' AS valid_end_date, "
        "CASE WHEN l_returnflag = 'R' THEN 'D' END AS invalid_reason FROM lineitem "
        "UNION ALL SELECT l_suppkey, l_partkey, 'Supplies', CAST(l_shipdate AS DATE), DATE '2099-12-31', "
        "CASE WHEN l_returnflag = 'R' THEN 'D' END FROM lineitem), "
        "r AS (SELECT * FROM (VALUES ('Supplied by', 'Supplies'), ('Supplies', 'Supplied by')) "
        "v(relationship_id, reverse_relationship_id)) "
        "SELECT concept_id_1 AS part_id, count(DISTINCT concept_id_2) AS n_suppliers FROM e "
        "WHERE invalid_reason IS NULL AND DATE '1998-01-01' BETWEEN valid_start_date AND valid_end_date "
        "AND relationship_id IN (SELECT reverse_relationship_id FROM r WHERE relationship_id = 'Supplies') "
        "GROUP BY concept_id_1",
    "quarantine_split": "SELECT CASE WHEN l.doc_id IS NULL THEN 'orphan' ELSE 'cohort' END AS dest, "
                        "count(*) AS n FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id) GROUP BY 1",
    "red_overlay": "SELECT event_id, CASE WHEN value < 0 OR value > 200 THEN NULL ELSE value END AS value, "
                   "(value < 0 OR value > 200) AS is_red FROM events",
    "checksum_dedupe": "SELECT min(doc_id) AS doc_id, sha256(text) AS checksum FROM documents GROUP BY text",
    "era_events": (
        # both windows need the same total order: with ORDER BY d alone, tied
        # days may be ordered differently by lag() and by the running sum
        "WITH x AS (SELECT user_id, event_type, event_id, CAST(ts AS DATE) AS d FROM events), "
        "g AS (SELECT *, CASE WHEN date_diff('day', lag(d) OVER (PARTITION BY user_id, event_type "
        "ORDER BY d, event_id), d) <= 2 THEN 0 ELSE 1 END AS brk FROM x), "
        "i AS (SELECT *, sum(brk) OVER (PARTITION BY user_id, event_type ORDER BY d, event_id "
        "ROWS UNBOUNDED PRECEDING) AS era FROM g) "
        "SELECT user_id, event_type, min(d) AS era_start, max(d) AS era_end, count(*) AS n FROM i "
        "GROUP BY user_id, event_type, era"),
    "row_counts": "SELECT 'orders' AS tbl, count(*) AS n FROM orders UNION ALL "
                  "SELECT 'lineitem' AS tbl, count(*) AS n FROM lineitem",
}
ORACLE_SQL["validate_star"] = _star_oracle()
