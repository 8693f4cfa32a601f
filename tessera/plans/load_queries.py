"""Driver queries that go through files and the warehouse: what the given
tables look like written in the input formats, loaded, published, merged,
promoted and deleted.  Each builds its warehouse in a scratch folder."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import contracts
from ..functions import coerce
from ..functions.variant import json_field, json_items
from ..operators import checks, codebook, columns, derive, navigate
from ..session import scratch_path
from ..sinks import Warehouse
from ..sinks.warehouse import together
from ..sources import fs
from ..sources.codebook import read_codebooks
from ..sources.local_files import from_typed, read_delimited
from ..sources.vocab import read_vocab_file
from . import jobs


def table(spark, d, name):
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


def write_tsv(df, path):
    """In the vocabulary dialect: tabs, backspace as quote."""
    (df.write.option("sep", "\t").option("quote", "\b").option("escape", "\b").option("header", "true")
       .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").option("emptyValue", "").csv(path))


# S1 S2 F6 ----------------------------------------------------------------
ORDERS = contracts.ad_hoc("orders", "o_orderkey bigint!, o_orderdate date!, o_note vc40, o_totalprice dec, o_clerk vc9", pk="o_orderkey")


def scan_tsv_orders(spark, d):
    """Orders with the date in both spellings, quotes in a text column,
    blanks for NULL, and a column that the file lacks."""
    day = F.to_date("o_orderdate")
    path = scratch_path(spark, "orders-tsv")
    write_tsv(table(spark, d, "orders").select(
        F.when(F.col("o_orderkey") % 2 == 0, F.date_format(day, "yyyyMMdd")).otherwise(F.date_format(day, "yyyy-MM-dd")).alias("O_ORDERDATE"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(
            F.concat(F.lit('say "'), F.col("o_orderpriority"), F.when(F.col("o_orderstatus") == "F", '"').otherwise(""))).alias("o_note"),
        F.col("o_totalprice").cast("decimal(20,2)").cast("string").alias("O_TotalPrice"),
        F.col("o_orderkey").cast("string").alias("o_orderkey")), path)
    return read_vocab_file(spark, path, ORDERS).select(
        "o_orderkey", "o_orderdate", "o_note", F.col("o_totalprice").cast("double").alias("o_totalprice"), "o_clerk")


# S4 F3 P1 P2 P8 ----------------------------------------------------------
LINES = contracts.ad_hoc("lines", "l_orderkey int!, l_linenumber int!, l_returnflag text, l_quantity int, l_note text, "
                                  "l_active bool!=true, l_rank int=0")


def csv_lineitem(spark, d):
    """Line items as delimited text with the four NULL tokens, a padded and
    upper-case header, a column the table lacks and columns the file lacks."""
    path = scratch_path(spark, "lineitem-csv")
    token = F.element_at(F.array(*[F.lit(t) for t in coerce.NULL_TOKENS]), F.col("l_linenumber") % 4 + 1)
    (table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias(" L_ORDERKEY "), F.col("l_linenumber").alias("l_linenumber"),
        F.when(F.col("l_returnflag") == "R", token).otherwise(F.col("l_returnflag")).alias("L_ReturnFlag"),
        F.concat(F.lit(" "), F.col("l_quantity").cast("string")).alias("l_quantity"),
        F.when(F.col("l_linestatus") == "O", 'a "quoted", one').otherwise(" ").alias("l_note"),
        F.col("l_tax").alias("colour")).write.option("header", "true").option("escape", '"').option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path))
    raw = columns.normalize_names(read_delimited(spark, path))
    typed = []
    for c in columns.known_columns(raw, LINES):
        value, error = coerce.python_cast(F.col(c), LINES.column(c))
        typed.append(coerce.strict(value, error).alias(c))
    return columns.fill_defaults(raw.select(*typed), LINES)


# S5 ----------------------------------------------------------------------
def typed_customer(spark, d):
    """A typed frame turned into text first, as a parsed spreadsheet is, then
    coerced; the NULL tokens do not apply to it."""
    raw = from_typed(table(spark, d, "customer").select(
        F.col("c_custkey").cast("double").alias("id"), (F.col("c_acctbal") > 0).alias("positive"),
        F.when(F.col("c_mktsegment") == "BUILDING", "None").otherwise(F.col("c_mktsegment")).alias("segment")))
    id_, e1 = coerce.to_int(F.col("id"))
    pos, e2 = coerce.to_bool(F.col("positive"))
    return raw.select(coerce.strict(id_, e1).alias("c_custkey"), coerce.strict(pos, e2).alias("positive"), "segment")


# S7 F9 P5 A3 R9 ----------------------------------------------------------
def _books(spark, d):
    """One codebook file per brand, its questions the brand's parts."""
    path = scratch_path(spark, "codebooks")
    question = F.to_json(F.struct(F.concat(F.col("p_name"), F.lit(" "), F.col("p_partkey").cast("string")).alias("name"),
                                  F.col("p_size").alias("size")))
    brand = F.translate("p_brand", "#", "-")
    # a line per question between the lines that open and close the document
    rows = table(spark, d, "part").select(brand.alias("book"), F.lit(1).alias("o"), F.concat(question, F.lit(",")).alias("line"))
    ends = rows.select("book").distinct().select("book", F.explode(F.map_from_entries(F.array(
        F.struct(F.lit(0), F.lit('{"questions": [')), F.struct(F.lit(2), F.lit('{"name": "end", "size": -1}]}'))))).alias("o", "line"))
    ends = ends.withColumn("line", F.replace("line", F.lit('"end"'), F.concat(F.lit('"end of '), F.col("book"), F.lit('"'))))
    (rows.unionByName(ends).repartition("book").sortWithinPartitions("book", "o").select("book", "line")
         .write.partitionBy("book").text(path))
    names = [n.split("=", 1)[1] for n in fs.list_names(spark, path) if n.startswith("book=")]
    for n in names:
        fs.rename(spark, f"{path}/book={n}", f"{path}/Codebook_{n}.json")
    return read_codebooks(spark, path, names)


def codebook_merge(spark, d):
    items = codebook.merge(_books(spark, d))
    return items.select("name", "codebook", json_field(F.col("question"), "$.size", "int").alias("size"))


def codebook_items(spark, d):
    """the array inside each event's document, flattened."""
    doc = F.parse_json(F.concat(F.lit('{"items": ['), F.col("props"), F.lit(", "), F.col("props"), F.lit("]}")))
    items = table(spark, d, "events").select("event_id", F.posexplode(json_items(doc, "$.items")).alias("pos", "item"))
    return items.select("event_id", "pos", json_field(F.col("item"), "$.k", "int").alias("k"))


def unregistered_questions(spark, d):
    part = table(spark, d, "part")
    items = part.select(F.col("p_name").alias("name"), F.col("p_brand").alias("codebook"))
    registry = part.where("p_size = 50").select(F.col("p_name").alias("source_field_name"))
    return codebook.unregistered(items, registry)


# K1 S3 A1 C6 -------------------------------------------------------------
def _vocabulary_files(spark, d, folder):
    part = table(spark, d, "part").withColumn("cls", F.concat(F.lit("Size "), F.col("p_size").cast("string")))
    part = part.withColumn("top", F.min("p_partkey").over(Window.partitionBy("cls")))
    dates = [F.lit("19700101").alias("valid_start_date"), F.lit("2099-12-31").alias("valid_end_date")]
    none = F.lit(None).cast("string").alias("invalid_reason")
    first = F.min("p_partkey")
    frames = {
        "DOMAIN.csv": part.groupBy(F.lit("Part").alias("domain_id")).agg(F.lit("Part").alias("domain_name"), first.alias("domain_concept_id")),
        "VOCABULARY.csv": part.groupBy(F.col("p_brand").alias("vocabulary_id")).agg(
            F.first("p_brand").alias("vocabulary_name"), first.alias("vocabulary_concept_id")),
        "CONCEPT_CLASS.csv": part.groupBy(F.col("cls").alias("concept_class_id")).agg(
            F.first("cls").alias("concept_class_name"), first.alias("concept_class_concept_id")),
        "RELATIONSHIP.csv": part.groupBy(F.col("cls").alias("relationship_id")).agg(
            F.first("cls").alias("relationship_name"), F.lit("0").alias("is_hierarchical"), F.lit("0").alias("defines_ancestry"),
            F.first("cls").alias("reverse_relationship_id"), first.alias("relationship_concept_id")),
        "CONCEPT.csv": part.select(
            F.col("p_partkey").alias("concept_id"), F.col("p_name").alias("concept_name"), F.lit("Part").alias("domain_id"),
            F.col("p_brand").alias("vocabulary_id"), F.col("cls").alias("concept_class_id"), F.lit("S").alias("standard_concept"),
            F.col("p_partkey").alias("concept_code"), *dates, none),
        "CONCEPT_RELATIONSHIP.csv": part.select(F.col("p_partkey").alias("concept_id_1"), F.col("top").alias("concept_id_2"),
                                                F.col("cls").alias("relationship_id"), *dates, none),
        "CONCEPT_ANCESTOR.csv": part.select(F.col("top").alias("ancestor_concept_id"), F.col("p_partkey").alias("descendant_concept_id"),
                                            F.lit(1).alias("min_levels_of_separation"), F.lit(1).alias("max_levels_of_separation")),
        "CONCEPT_SYNONYM.csv": part.select(F.col("p_partkey").alias("concept_id"), F.col("p_type").alias("concept_synonym_name"),
                                           F.col("top").alias("language_concept_id")),
        "DRUG_STRENGTH.csv": table(spark, d, "lineitem").select(
            F.col("l_partkey").alias("drug_concept_id"), F.col("l_partkey").alias("ingredient_concept_id"),
            F.col("l_quantity").alias("amount_value"), F.col("l_linenumber").alias("box_size"), *dates, none),
    }
    together(spark, {name: lambda name=name, df=df: write_tsv(
        df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]), f"{folder}/{name}") for name, df in frames.items()})


def load_vocabulary_parts(spark, d):
    """All nine vocabulary files, written from the parts and line items, then
    checked and published in one load; its counts as rows."""
    folder = scratch_path(spark, "vocabulary")
    _vocabulary_files(spark, d, folder)
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    jobs.setup_layer(wh)
    counts = jobs.load_vocabulary(wh, folder)
    return spark.createDataFrame(sorted(counts.items()), "tbl string, n long")


# K2 K3 K4 ----------------------------------------------------------------
def _local_concepts(spark, df):
    path = scratch_path(spark, "local") + ".csv"
    df.write.option("header", "true").option("escape", '"').csv(path)
    return path


def _fields(part):
    return part.select((F.col("p_partkey") + 1).alias("id"), F.col("p_name").alias("source_field_name"),
                       F.col("p_brand").alias("dataset"), F.lit("{}").alias("source_field_range"))


def replace_local_concepts(spark, d):
    """A dry run that writes nothing, a replace without ids (numbered from 1 in
    file order) and a second replace; what each reports and leaves."""
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    jobs.setup_layer(wh)
    part = table(spark, d, "part")
    path = _local_concepts(spark, _fields(part).drop("id"))
    out = [("dry run", jobs.load_local_concepts(wh, path, dry_run=True)["rows"])]
    for step in ("first", "second"):
        out.append((f"{step} replace", jobs.load_local_concepts(wh, path)["inserted"]))
    left = wh.read("shared", "local_concept").agg(F.count("id"), F.min("id"), F.max("id"), F.count_distinct("id"),
                                                   F.count_if(F.col("is_active"))).first()
    out += list(zip(("rows", "lowest id", "highest id", "ids", "active"), left))
    return spark.createDataFrame([(k, int(n)) for k, n in out], "step string, n long")


def upsert_into_table(spark, d):
    """K3 through the sink: parts of odd size inserted first, then all large
    ones upserted with another name; ``id`` and ``created_at`` stay, columns
    the second file lacks keep their values or take their defaults."""
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    jobs.setup_layer(wh)
    part = table(spark, d, "part")
    jobs.load_local_concepts(wh, _local_concepts(spark, _fields(part.where("p_size % 2 = 1"))))
    later = _fields(part.where("p_size > 25")).select("id", F.upper("source_field_name").alias("source_field_name"))
    jobs.load_local_concepts(wh, _local_concepts(spark, later), mode="upsert")
    return wh.read("shared", "local_concept").select(
        "id", "source_field_name", "dataset", "is_active", F.to_json("source_field_range").alias("range"),
        (F.col("updated_at") >= F.col("created_at")).alias("ordered"))


# K5 K6 -------------------------------------------------------------------
def custom_vocabularies(spark, d):
    """Each brand, type and size of part as a custom vocabulary, all in one
    append; one of them removed again."""
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    jobs.setup_layer(wh)
    kinds = table(spark, d, "part").groupBy("p_brand", "p_type", "p_size").agg(F.min("p_partkey").alias("first"))
    name = F.concat_ws(" ", "p_brand", "p_type", F.col("p_size").cast("string"))
    jobs.add_custom_vocabularies(wh, kinds.select(
        (F.col("first") + 2_000_000_000).cast("int").alias("concept_id"), F.concat(F.lit("V"), F.col("first").cast("string")).alias("vocabulary_id"),
        name.alias("concept_name"), name.alias("vocabulary_name"), F.lit(None).cast("string").alias("reference"), F.lit("v1").alias("version")))
    jobs.remove_custom_vocabulary(wh, 2_000_000_000, "V0")
    return wh.read("shared", "vocabulary").join(
        wh.read("shared", "concept"), F.col("vocabulary_concept_id") == F.col("concept_id"), "full").select(
        "concept_id", "concept_name", "vocabulary_name", "vocabulary_version")


# J7 K6 -------------------------------------------------------------------
def delete_cascade_survivors(spark, d):
    """Measurements above a value deleted from the warehouse; their red-flag
    rows go with them (ON DELETE CASCADE), in the same publish."""
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    jobs.setup_layer(wh, cohorts=["cohort_1"])
    ev = table(spark, d, "events")
    measured = ev.select(F.col("event_id").cast("int").alias("measurement_id"), F.col("user_id").cast("int").alias("person_id"),
                         F.lit(0).alias("measurement_concept_id"), F.to_date("ts").alias("measurement_date"),
                         F.lit(0).alias("measurement_type_concept_id"), F.col("value").cast("decimal(38,10)").alias("value_as_number"))
    red = ev.where("event_type != 'view'").select(
        F.col("event_id").cast("int").alias("measurement_id"), F.col("user_id").alias("appointment_id"), F.col("event_type").alias("field_name"),
        F.lit(1).cast("short").alias("created_by"), F.col("ts").cast("timestamp_ntz").alias("created_on"), F.lit(0).cast("short").alias("status"))
    wh.append("cohort_1", {"measurement": measured, "red_measurement": red}, check=False)
    wh.delete_where("cohort_1", "measurement", F.col("value_as_number") > 50)
    return wh.read("cohort_1", "red_measurement").select("measurement_id", "field_name")


# K7 K8 S8 S9 P6 P7 R1 A1 -------------------------------------------------
def promoted_cohorts(spark, d):
    """A cohort schema per market segment with its persons and their visits,
    checked on the way from bronze through silver to gold, one cohort dropped
    from gold; the rows of every table that each layer lists."""
    root = scratch_path(spark, "warehouse")
    cust, orders = table(spark, d, "customer"), table(spark, d, "orders")
    segments = [r[0] for r in cust.select("c_mktsegment").distinct().orderBy("c_mktsegment").collect()]  # one schema each
    layers = {name: Warehouse(spark, root, name) for name in ("bronze", "silver", "gold")}
    cohorts = [f"cohort_{s.lower()}" for s in segments]
    jobs.setup_layer(layers["bronze"], cohorts)
    part = table(spark, d, "part").where("p_partkey = 0")  # the concept that persons and visits refer to
    layers["bronze"].append("shared", {"concept": part.select(
        F.col("p_partkey").cast("int").alias("concept_id"), F.col("p_name").alias("concept_name"), F.lit("Part").alias("domain_id"),
        F.col("p_brand").alias("vocabulary_id"), F.col("p_type").alias("concept_class_id"), F.lit("0").alias("concept_code"),
        F.lit("1970-01-01").cast("date").alias("valid_start_date"), F.lit("2099-12-31").cast("date").alias("valid_end_date"))}, check=False)

    def load(segment, cohort):
        own = cust.where(F.col("c_mktsegment") == segment)
        person = own.select(F.col("c_custkey").cast("int").alias("person_id"), F.lit(0).alias("gender_concept_id"),
                            F.lit(1970).alias("year_of_birth"), F.lit(0).alias("race_concept_id"), F.lit(0).alias("ethnicity_concept_id"))
        # merged: five broadcasts of customers at once would fill the driver
        visits = orders.join(own.hint("merge"), F.col("o_custkey") == F.col("c_custkey"), "left_semi").select(
            F.col("o_orderkey").cast("int").alias("visit_occurrence_id"), F.col("o_custkey").cast("int").alias("person_id"),
            F.lit(0).alias("visit_concept_id"), F.to_date("o_orderdate").alias("visit_start_date"),
            F.to_date("o_orderdate").alias("visit_end_date"), F.lit(0).alias("visit_type_concept_id"))
        layers["bronze"].append(cohort, {"person": person, "visit_occurrence": visits}, check=False)
    together(spark, {c: lambda s=s, c=c: load(s, c) for s, c in zip(segments, cohorts)})
    for src, dst in (("bronze", "silver"), ("silver", "gold")):
        jobs.promote(layers[src], layers[dst], "shared", check=False)
        together(spark, {c: lambda c=c: jobs.promote(layers[src], layers[dst], c) for c in layers[src].cohorts()})
    layers["gold"].drop_schema(cohorts[0])
    parts = []
    for name, wh in layers.items():
        for cohort in wh.cohorts():
            for t in ("person", "visit_occurrence", "red_measurement", "source_logs"):
                if t in wh.tables(cohort):
                    parts.append(wh.read(cohort, t).agg(F.count(F.lit(1)).alias("n")).select(
                        F.lit(name).alias("layer"), F.lit(cohort).alias("cohort"), F.lit(t).alias("tbl"), "n"))
    return reduce(lambda a, b: a.unionByName(b), parts)


# C2 C6 -------------------------------------------------------------------
LABELLED = contracts.ad_hoc("documents", "doc_id bigint!, lang vc2!, source vc4", pk="doc_id", fks=["doc_id -> x.labels.doc_id"])


def validate_documents(spark, d):
    """The stacked report with broken keys: documents without label, and
    sources longer than their column."""
    return checks.validate_tables({"documents": table(spark, d, "documents").select("doc_id", "lang", "source")}, {"documents": LABELLED},
                                  parents={"labels": table(spark, d, "labels")})


# J2 J4 -------------------------------------------------------------------
def nav_order_lines(spark, d):
    return navigate.one_to_many(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), table(spark, d, "lineitem"),
                                "o_orderkey", "l_orderkey", ["l_linenumber", "l_partkey"])


def nav_following_events(spark, d):
    """Events with the events that point back at them (the one 100 before)."""
    ev = table(spark, d, "events").select("event_id", "event_type", (F.col("event_id") - 100).alias("ref"))
    return navigate.self_one_to_many(ev.select("event_id"), "ref", "event_id", ["event_type"], "following_",
                                     parent=ev.select("ref", "event_type"))


# R8 R13 ------------------------------------------------------------------
def _concepts(spark, d):
    return table(spark, d, "part").select(F.col("p_partkey").alias("concept_id"), F.col("p_name").alias("concept_name"))


def drug_strength_names(spark, d):
    """Five concept references of each line, two of them optional."""
    strength = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("drug_concept_id"), F.col("l_suppkey").alias("ingredient_concept_id"),
        F.col("l_linenumber").cast("long").alias("amount_unit_concept_id"),
        F.when(F.col("l_returnflag") == "R", F.col("l_orderkey") % 50).alias("numerator_unit_concept_id"),
        F.lit(None).cast("long").alias("denominator_unit_concept_id"))
    out = derive.drug_strength(strength, _concepts(spark, d))
    return out.select("l_orderkey", "l_linenumber", *[
        F.col(f"{c}_concept_id__concept_name").alias(c) for c in ("drug", "ingredient", "amount_unit", "numerator_unit", "denominator_unit")])


def concept_synonyms(spark, d):
    syn = table(spark, d, "lineitem").select(F.col("l_partkey").alias("concept_id"), F.col("l_returnflag").alias("concept_synonym_name"),
                                             F.col("l_linenumber").cast("long").alias("language_concept_id"))
    return derive.synonyms(_concepts(spark, d), syn)


def source_lineage(spark, d):
    """Log -> instrument -> assessment, machine, place and cohort; log ->
    endpoint -> api."""
    nation, region, cust = table(spark, d, "nation"), table(spark, d, "region"), table(spark, d, "customer")
    named = nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    regions = region.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))
    logs = table(spark, d, "events").select(
        F.col("event_id").alias("id"), F.when(F.col("event_type") != "error", F.col("user_id")).alias("instrument_id"),
        (F.col("event_id") % 25).cast("int").alias("endpoint_id"))
    instruments = cust.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("assessment_id"),
                              (F.col("c_nationkey") % 5).alias("machine_id"), F.col("c_nationkey").alias("place_id"),
                              (F.col("c_custkey") % 5).cast("int").alias("cohort_id"))
    out = derive.source_lineage(
        logs, instruments, nation.select(F.col("n_nationkey").alias("id"), F.col("n_regionkey").alias("api_id"),
                                         F.col("n_name").alias("path"), F.lit("GET").alias("method")),
        regions, named, regions, named.select("id", F.col("name").alias("city"), F.lit("XX").alias("state")),
        regions.select("id", F.col("name").alias("cohort_name"), F.lower("name").alias("schema_name")))
    return out.select("id", "assessment_name", "machine_name", "place_city", "cohort_name", "schema_name", "path", F.col("name").alias("api_name"))


# R4 R6 -------------------------------------------------------------------
def mapping_by_vocabulary(spark, d):
    """Codes looked up with their vocabulary; invalid mappings do not count."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate")
    mapping = lines.select(F.col("l_returnflag").alias("source_code"), F.col("l_linestatus").alias("source_vocabulary_id")).distinct().select(
        "*", F.concat("source_vocabulary_id", "source_code").alias("target_concept_id"), F.lit("1995-01-01").cast("date").alias("valid_start_date"),
        F.lit("1999-12-31").cast("date").alias("valid_end_date"), F.when(F.col("source_code") == "R", "D").alias("invalid_reason"))
    out = derive.map_source_codes(lines, mapping, "l_returnflag", F.to_date("l_shipdate"), vocabulary_col="l_linestatus")
    return out.select("l_orderkey", "l_linenumber", "target_concept_id")


def rollup_levels(spark, d):
    """Customers per ancestor of their nation, one level up at most."""
    nation = table(spark, d, "nation")

    def level(name, n):
        return F.struct(name.alias("ancestor"), F.lit(n).alias("min_levels_of_separation"))
    edges = nation.select(F.col("n_nationkey").alias("descendant"), F.explode(F.array(
        level(F.col("n_name"), 0), level(F.concat(F.lit("region "), F.col("n_regionkey").cast("string")), 1),
        level(F.lit("world"), 2))).alias("e")).select("descendant", "e.*")
    return derive.rollup(table(spark, d, "customer"), "c_nationkey", edges, "descendant", "ancestor", max_levels=1)


# R10 ---------------------------------------------------------------------
def route_records(spark, d):
    """Documents routed to three places and read back from there: labelled
    ones, those of a source listed as faulty, and the rest."""
    docs = table(spark, d, "documents").select("doc_id", "lang")
    errors = docs.where("doc_id % 7 = 0").select("doc_id")
    attributed = derive.attribute(docs, table(spark, d, "labels"), "doc_id", errors)
    out = []
    for dest, rows in derive.route(attributed).items():
        path = scratch_path(spark, dest)
        rows.write.parquet(path)
        out.append(spark.read.schema(rows.schema).parquet(path).withColumn("dest", F.lit(dest)))
    return reduce(lambda a, b: a.unionByName(b), out)


QUERIES = {f.__name__: f for f in (
    scan_tsv_orders, csv_lineitem, typed_customer, codebook_merge, codebook_items, unregistered_questions, load_vocabulary_parts,
    replace_local_concepts, upsert_into_table, custom_vocabularies, delete_cascade_survivors, promoted_cohorts, validate_documents,
    nav_order_lines, nav_following_events, mapping_by_vocabulary, rollup_levels, drug_strength_names, concept_synonyms, source_lineage, route_records)}

ORACLE_SQL = {
    "scan_tsv_orders": "SELECT o_orderkey, o_orderdate::DATE AS o_orderdate, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE "
                       "'say \"' || o_orderpriority || CASE WHEN o_orderstatus = 'F' THEN '\"' ELSE '' END END AS o_note, "
                       "o_totalprice::DECIMAL(20,2)::DOUBLE AS o_totalprice, NULL::VARCHAR AS o_clerk FROM orders",
    "csv_lineitem": "SELECT l_orderkey::INT AS l_orderkey, l_linenumber, CASE WHEN l_returnflag <> 'R' THEN l_returnflag END AS l_returnflag, "
                    "trunc(l_quantity)::INT AS l_quantity, CASE WHEN l_linestatus = 'O' THEN 'a \"quoted\", one' ELSE ' ' END AS l_note, "
                    "TRUE AS l_active, 0 AS l_rank FROM lineitem",
    "typed_customer": "SELECT c_custkey::INT AS c_custkey, c_acctbal > 0 AS positive, "
                      "CASE WHEN c_mktsegment = 'BUILDING' THEN 'None' ELSE c_mktsegment END AS segment FROM customer",
    "codebook_merge": "SELECT p_name || ' ' || p_partkey::VARCHAR AS name, replace(p_brand, '#', '-') AS codebook, p_size AS size FROM part "
                      "UNION ALL SELECT 'end of ' || b, b, -1 FROM (SELECT DISTINCT replace(p_brand, '#', '-') AS b FROM part)",
    "codebook_items": "SELECT event_id, pos, json_extract(props, '$.k')::INT AS k FROM events, (VALUES (0), (1)) v(pos)",
    "unregistered_questions": "SELECT p_name AS name, p_brand AS codebook FROM part WHERE p_name NOT IN "
                              "(SELECT p_name FROM part WHERE p_size = 50)",
    "load_vocabulary_parts": "SELECT unnest(['domain', 'vocabulary', 'concept_class', 'relationship', 'concept', 'concept_relationship', "
                             "'concept_ancestor', 'concept_synonym', 'drug_strength']) AS tbl, unnest([1, count(DISTINCT p_brand), "
                             "count(DISTINCT p_size), count(DISTINCT p_size), count(*), count(*), count(*), count(*), "
                             "(SELECT count(*) FROM lineitem)]) AS n FROM part",
    "replace_local_concepts": "SELECT unnest(['dry run', 'first replace', 'second replace', 'rows', 'lowest id', 'highest id', 'ids', 'active']) "
                              "AS step, unnest([count(*), count(*), count(*), count(*), 1, count(*), count(*), count(*)]) AS n FROM part",
    "upsert_into_table": "SELECT (p_partkey + 1)::INT AS id, CASE WHEN p_size > 25 THEN upper(p_name) ELSE p_name END AS source_field_name, "
                         "CASE WHEN p_size % 2 = 1 THEN p_brand END AS dataset, TRUE AS is_active, "
                         "CASE WHEN p_size % 2 = 1 THEN '{}' END AS range, TRUE AS ordered FROM part WHERE p_size % 2 = 1 OR p_size > 25",
    "custom_vocabularies": "SELECT (2000000000 + min(p_partkey))::INT AS concept_id, p_brand || ' ' || p_type || ' ' || p_size AS concept_name, "
                           "p_brand || ' ' || p_type || ' ' || p_size AS vocabulary_name, 'v1' AS vocabulary_version FROM part "
                           "GROUP BY p_brand, p_type, p_size HAVING min(p_partkey) > 0",
    "delete_cascade_survivors": "SELECT event_id::INT AS measurement_id, event_type AS field_name FROM events "
                                "WHERE event_type <> 'view' AND NOT coalesce(value > 50, FALSE)",
    "promoted_cohorts": "WITH c AS (SELECT c_mktsegment AS s, count(*) AS n FROM customer GROUP BY 1), "
                        "o AS (SELECT c_mktsegment AS s, count(*) AS m FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1) "
                        "SELECT layer, 'cohort_' || lower(s) AS cohort, tbl, CASE tbl WHEN 'person' THEN n WHEN 'visit_occurrence' THEN coalesce(m, 0) ELSE 0 END AS n "
                        "FROM c LEFT JOIN o USING (s), (VALUES ('bronze', 'person'), ('bronze', 'visit_occurrence'), ('bronze', 'red_measurement'), "
                        "('bronze', 'source_logs'), ('silver', 'person'), ('silver', 'visit_occurrence'), ('silver', 'red_measurement'), "
                        "('gold', 'person'), ('gold', 'visit_occurrence')) v(layer, tbl) WHERE layer <> 'gold' OR s > (SELECT min(s) FROM c)",
    "validate_documents": "SELECT 'documents' AS table_name, 'foreign_key:labels.doc_id' AS constraint_name, 'doc_id' AS columns, "
                          "doc_id::VARCHAR AS key, count(*) AS n FROM documents WHERE doc_id IS NOT NULL AND doc_id NOT IN "
                          "(SELECT doc_id FROM labels WHERE doc_id IS NOT NULL) GROUP BY doc_id "
                          "UNION ALL SELECT 'documents', 'primary_key', 'doc_id', '{\"doc_id\":' || doc_id || '}', count(*) FROM documents "
                          "WHERE doc_id IS NOT NULL GROUP BY doc_id HAVING count(*) > 1 "
                          "UNION ALL SELECT 'documents', 'max_length_4', 'source', NULL, count(*) FROM documents WHERE length(source) > 4 "
                          "HAVING count(*) > 0 UNION ALL SELECT 'documents', 'max_length_2', 'lang', NULL, count(*) FROM documents "
                          "WHERE length(lang) > 2 HAVING count(*) > 0",
    "nav_order_lines": "SELECT o_orderkey, o_orderstatus, l_linenumber, l_partkey FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey",
    "nav_following_events": "SELECT a.event_id, b.event_type AS following_event_type FROM events a LEFT JOIN events b "
                            "ON b.event_id - 100 = a.event_id",
    "drug_strength_names": "SELECT l_orderkey, l_linenumber, a.p_name AS drug, b.p_name AS ingredient, c.p_name AS amount_unit, "
                           "e.p_name AS numerator_unit, NULL::VARCHAR AS denominator_unit FROM lineitem LEFT JOIN part a ON a.p_partkey = l_partkey "
                           "LEFT JOIN part b ON b.p_partkey = l_suppkey LEFT JOIN part c ON c.p_partkey = l_linenumber "
                           "LEFT JOIN part e ON e.p_partkey = l_orderkey % 50 AND l_returnflag = 'R'",
    "concept_synonyms": "SELECT p.p_partkey AS concept_id, p.p_name AS concept_name, l_returnflag AS concept_synonym_name, "
                        "q.p_name AS language_concept_name FROM part p LEFT JOIN lineitem ON l_partkey = p.p_partkey "
                        "LEFT JOIN part q ON q.p_partkey = l_linenumber",
    "source_lineage": "SELECT event_id AS id, n.n_name AS assessment_name, m.r_name AS machine_name, n.n_name AS place_city, "
                      "h.r_name AS cohort_name, lower(h.r_name) AS schema_name, e.n_name AS path, a.r_name AS api_name FROM events "
                      "LEFT JOIN customer ON c_custkey = user_id AND event_type <> 'error' LEFT JOIN nation n ON n.n_nationkey = c_nationkey "
                      "LEFT JOIN region m ON m.r_regionkey = c_nationkey % 5 LEFT JOIN region h ON h.r_regionkey = c_custkey % 5 "
                      "LEFT JOIN nation e ON e.n_nationkey = event_id % 25 LEFT JOIN region a ON a.r_regionkey = e.n_regionkey",
    "mapping_by_vocabulary": "SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag <> 'R' AND l_shipdate::DATE BETWEEN DATE '1995-01-01' "
                             "AND DATE '1999-12-31' THEN l_linestatus || l_returnflag END AS target_concept_id FROM lineitem",
    "rollup_levels": "SELECT n_name AS ancestor, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1 "
                     "UNION ALL SELECT 'region ' || n_regionkey, count(*) FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1",
    "route_records": "SELECT doc_id, lang, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'cohort' "
                     "WHEN doc_id % 7 = 0 THEN 'identifier_errors' ELSE 'orphan' END AS dest FROM documents",
}
