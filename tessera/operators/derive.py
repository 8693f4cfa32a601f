"""Warehouse work the contract declares (R2-R15; R1 is a job in plans.jobs).

Each function is a composition of joins, aggregations and windows; the
comments say where the shuffle is and what bounds it.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.variant import canonical_json
from ..session import cut_lineage
from . import intervals, navigate


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


# R2 ----------------------------------------------------------------------

def union_cohorts(frames: dict[str, DataFrame], tag_col: str = "cohort") -> DataFrame:
    """Cross-cohort union by column name, each row tagged with its cohort.
    Schemas must match exactly (no silent NULL padding).  No shuffle."""
    parts = [df.select(F.lit(name).alias(tag_col), *[_q(c) for c in df.columns])
             for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=False), parts)


# R3 / R8 -----------------------------------------------------------------

def enrich_concepts(df: DataFrame, concept: DataFrame, columns, take=("concept_name",),
                    concept_key: str = "concept_id") -> DataFrame:
    """Name (or otherwise describe) every ``*_concept_id`` column: one left
    join per column attaches the attributes as ``<column>__<attr>``.

    The vocabulary is first cut to the ids that the frame uses (stacked,
    deduplicated, semi-join) and the cut is written to the shared checkpoint
    folder, so it is worked out once for all columns, the frame is read twice
    in all, and Spark knows the size of what it joins.  Rows with a NULL id
    are spread (see ``navigate.many_to_one``).
    """
    columns = list(columns)
    if not columns:
        return df
    ktype = dict(concept.dtypes)[concept_key]
    used = (df.select(F.explode(F.array(*[_q(c).cast(ktype) for c in columns])).alias(concept_key))
              .where(F.col(concept_key).isNotNull()).distinct())
    subset = cut_lineage(concept.select(concept_key, *take).join(used, concept_key, "left_semi"), "concepts")
    out = df
    for c in columns:
        out = navigate.many_to_one(out, subset, c, concept_key, list(take), prefix=f"{c}__")
    return out


def drug_strength(strength: DataFrame, concept: DataFrame) -> DataFrame:
    """Drug strength rows with the names of the five concepts they refer
    to (drug, ingredient and the three units)."""
    refs = ["drug_concept_id", "ingredient_concept_id", "amount_unit_concept_id",
            "numerator_unit_concept_id", "denominator_unit_concept_id"]
    return enrich_concepts(strength, concept, [c for c in refs if c in strength.columns])


def synonyms(concept: DataFrame, concept_synonym: DataFrame) -> DataFrame:
    """Concept rows with each synonym and its language's name."""
    syn = navigate.many_to_one(concept_synonym, concept, "language_concept_id", "concept_id",
                               ["concept_name"], prefix="language_")
    return navigate.one_to_many(concept.select("concept_id", "concept_name"), syn, "concept_id",
                                "concept_id", ["concept_synonym_name", "language_concept_name"])


# R4 ----------------------------------------------------------------------

def map_source_codes(events: DataFrame, mapping: DataFrame, code_col: str, date_col: Column | str,
                     take=("target_concept_id",), vocabulary_col: str | None = None,
                     valid_only: bool = True, hint_broadcast: bool = False, bucket_days: int = 30) -> DataFrame:
    """Source code -> target concept valid on the event's date.

    The join is on code, vocabulary when given, and date bucket (see
    ``intervals.window_join``), so a code that holds most events is spread
    over the buckets of its dates; LEFT so unmapped events stay.  Spark
    broadcasts the mapping when its statistics, or AQE's measurement, show
    that it is small.  ``hint_broadcast`` is for a caller who knows the
    mapping's size where Spark cannot.
    """
    m = mapping
    if valid_only and "invalid_reason" in mapping.columns:
        m = m.where(F.col("invalid_reason").isNull())
    keys = {code_col: "source_code", **({vocabulary_col: "source_vocabulary_id"} if vocabulary_col else {})}
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    return intervals.window_join(events, m, keys, d, "valid_start_date", "valid_end_date", take, bucket_days, hint_broadcast)


def overlapping_mappings(mapping: DataFrame, valid_only: bool = True) -> DataFrame:
    """Mappings whose validity begins before an earlier one of the same code
    and vocabulary has ended; events in the overlap are mapped twice."""
    m = mapping
    if valid_only and "invalid_reason" in mapping.columns:
        m = m.where(F.col("invalid_reason").isNull())
    keys = [c for c in ("source_code", "source_vocabulary_id") if c in m.columns]
    return intervals.overlapping(m, keys, "valid_start_date", "valid_end_date")


# R5 ----------------------------------------------------------------------

def route_fields(wide: DataFrame, local_concept: DataFrame, id_cols, cohort: int | Column,
                 hint_broadcast: bool = False) -> DataFrame:
    """Unpivot a wide record to (ids..., source_field_name, value), then attach
    the local concept and target ``table`` registered for the field.  The
    caller splits by ``table``.  ``unpivot`` is a narrow operation.

    The join key is the field name, which has only as many values as there
    are fields.  A registry is small, so Spark broadcasts it on its statistics
    or AQE's measurement; should it not, the fields of a record are large
    partitions that AQE's skew-join handling splits.  ``hint_broadcast`` is for
    a caller who knows the registry's size where Spark cannot.  The join is
    left so unknown fields surface with a NULL concept."""
    id_cols = list(id_cols)
    value_cols = [c for c in wide.columns if c not in id_cols]
    long = wide.select(*[_q(c) for c in id_cols],
                       *[_q(c).cast("string").alias(c) for c in value_cols]) \
               .unpivot(id_cols, value_cols, "source_field_name", "value")
    reg = local_concept.where(F.col("is_active"))
    reg = reg.where(F.col("cohort") == (cohort if isinstance(cohort, Column) else F.lit(cohort)))
    reg = reg.select("source_field_name", "concept_id", F.col("table").alias("target_table"))
    if hint_broadcast:
        reg = F.broadcast(reg)
    return navigate.many_to_one(long, reg, "source_field_name", "source_field_name",
                                ["concept_id", "target_table"])


# R6 ----------------------------------------------------------------------

def rollup(events: DataFrame, key: str, edges: DataFrame, descendant: str, ancestor: str,
           out_ancestor: str = "ancestor", count_col: str = "n", weight: str | None = None,
           max_levels: int | None = None, level_col: str = "min_levels_of_separation") -> DataFrame:
    """Count (or sum ``weight`` of) events per ancestor of their key.

    Events are aggregated per key before the join (map-side partial
    aggregation collapses a hot key), so the join sees one row per distinct
    key; only then are counts spread to ancestors and summed again.
    """
    agg = F.count(F.lit(1)) if weight is None else F.sum(_q(weight))
    per_key = events.groupBy(_q(key).alias("_key")).agg(agg.alias("_n"))
    e = edges
    if max_levels is not None:
        e = e.where(F.col(level_col) <= max_levels)
    e = e.select(_q(descendant).alias("_key"), _q(ancestor).alias(out_ancestor))
    return per_key.join(e, "_key").groupBy(out_ancestor).agg(F.sum("_n").alias(count_col))


# R7 ----------------------------------------------------------------------

def related(concept_relationship: DataFrame, relationship_id: str | DataFrame,
            as_of: Column | None = None) -> DataFrame:
    """Valid (concept_id_1 -> concept_id_2) edges of one relationship.

    ``relationship_id`` is an id, or a one-column frame of ids such as
    ``reverse_of(...)``; how it meets the edges is left to Spark's statistics
    and AQE.  ``as_of`` keeps edges whose
    validity window contains that date.
    """
    e = concept_relationship.where(F.col("invalid_reason").isNull())
    if isinstance(relationship_id, DataFrame):
        ids = relationship_id.select(F.col(relationship_id.columns[0]).alias("_rid")).distinct()
        e = e.join(ids, F.col("relationship_id") == F.col("_rid"), "left_semi")
    else:
        e = e.where(F.col("relationship_id") == relationship_id)
    if as_of is not None:
        e = e.where(as_of.between(F.col("valid_start_date"), F.col("valid_end_date")))
    return e.select("concept_id_1", "concept_id_2")


def reverse_of(relationship: DataFrame, relationship_id: str) -> DataFrame:
    """The reverse relationship id, as a one-column frame (``related`` takes
    it in place of an id)."""
    return relationship.where(F.col("relationship_id") == relationship_id) \
                       .select(F.col("reverse_relationship_id"))


# R10 ---------------------------------------------------------------------

def attribute(records: DataFrame, participants: DataFrame, key, errors: DataFrame | None = None,
              dest_col: str = "dest", matched: str = "cohort", faulty: str = "identifier_errors",
              unmatched: str = "orphan") -> DataFrame:
    """Identifier attribution: tag each record with where it goes - the
    ``matched`` destination when its key has a participant, ``faulty`` when it
    has none but the key is listed in ``errors`` (or is NULL), else
    ``unmatched``.  ``_matches`` is the number of participants of the key;
    they are counted per key first, so records are not duplicated."""
    key = [key] if isinstance(key, str) else list(key)
    counts = participants.groupBy(*[_q(k) for k in key]).agg(F.count(F.lit(1)).alias("_matches"))
    out = navigate.many_to_one(records, counts, key, key, ["_matches"])
    bad = reduce(lambda a, b: a | b, [_q(k).isNull() for k in key])
    if errors is not None:
        listed = errors.select(*[_q(k) for k in key]).distinct().withColumn("_listed", F.lit(True))
        out = navigate.many_to_one(out, listed, key, key, ["_listed"])
        bad = bad | F.col("_listed").isNotNull()
    dest = F.when(F.col("_matches").isNotNull(), matched)
    dest = dest.when(bad, faulty).otherwise(unmatched) if errors is not None else dest.otherwise(unmatched)
    return out.withColumn(dest_col, dest).drop("_listed")


def route_counts(attributed: DataFrame, dest_col: str = "dest", count_col: str = "n") -> DataFrame:
    """Records per destination; a record with several participants is one."""
    return attributed.groupBy(dest_col).agg(F.count(F.lit(1)).alias(count_col))


def route(attributed: DataFrame, dest_col: str = "dest", names=("cohort", "identifier_errors", "orphan")) -> dict[str, DataFrame]:
    """The records of each destination, to be written there together."""
    return {n: attributed.where(F.col(dest_col) == n).drop(dest_col, "_matches") for n in names}


# R11 ---------------------------------------------------------------------

def checksum(payload: Column, canonical: bool = False, is_text: bool = True) -> Column:
    """SHA-256 hex digest of a text payload, or with ``canonical`` of the
    canonical form of a JSON one (``functions.variant.canonical_json``)."""
    return F.sha2(canonical_json(payload, is_text) if canonical else payload, 256)


def dedupe_by_checksum(df: DataFrame, payload: str, id_col: str, checksum_col: str = "checksum",
                       canonical: bool = False) -> DataFrame:
    """One row per distinct payload: the smallest id and the checksum.  With
    ``canonical`` JSON payloads (text or VARIANT) that differ only in key
    order, blanks or the spelling of numbers are one.

    Grouping is on the 64-character digest computed map-side, so the shuffle
    moves digests, not payloads; a payload repeated a billion times becomes
    one partial row per task.
    """
    digest = checksum(_q(payload), canonical, dict(df.dtypes)[payload] != "variant")
    return df.select(_q(id_col), digest.alias(checksum_col)).groupBy(checksum_col).agg(F.min(id_col).alias(id_col))


# R12 (by field: corrections.py) ------------------------------------------

def red_flags(df: DataFrame, value_col: str, low, high, flag_col: str = "is_red") -> DataFrame:
    """Split values outside [low, high]: the value is withheld (NULL) and the
    row is flagged.  Narrow; no shuffle."""
    v = _q(value_col)
    red = (v < F.lit(low)) | (v > F.lit(high))
    return df.withColumn(flag_col, red).withColumn(value_col, F.when(red, F.lit(None)).otherwise(v))


def overlay_corrections(df: DataFrame, red: DataFrame, key: str, value_col: str,
                        red_key: str | None = None, field_col: str = "field_name") -> DataFrame:
    """Apply a red-flag table's corrections to one field: ``coalesce(new_value,
    original_value)`` replaces the value where a correction row of that field
    exists.  Where the red table has no ``field_col`` all its rows are of it."""
    red_key = red_key or key
    if field_col in red.columns:
        red = red.where(_q(field_col) == value_col)
    fixes = red.select(_q(red_key).alias(key),
                       F.coalesce("new_value", "original_value").alias("_fixed"))
    out = navigate.many_to_one(df, fixes, key, key, ["_fixed"])
    typ = dict(df.dtypes)[value_col]
    return out.withColumn(value_col, F.coalesce(F.col("_fixed").cast(typ), _q(value_col))).drop("_fixed")


# R13 ---------------------------------------------------------------------

def source_lineage(source_logs: DataFrame, instruments: DataFrame, endpoints: DataFrame,
                   apis: DataFrame, assessments: DataFrame, machines: DataFrame,
                   places: DataFrame, cohorts: DataFrame | None = None) -> DataFrame:
    """source_logs -> instrument (assessment, machine, place, cohort) and ->
    endpoint -> api; every hop a left join on a declared key."""
    inst = navigate.path(source_logs, [
        (instruments.select("id", "assessment_id", "machine_id", "place_id", "cohort_id"),
         "instrument_id", "id", ["assessment_id", "machine_id", "place_id", "cohort_id"])])
    inst = navigate.many_to_one(inst, assessments, "assessment_id", "id", ["name"], "assessment_")
    inst = navigate.many_to_one(inst, machines, "machine_id", "id", ["name"], "machine_")
    inst = navigate.many_to_one(inst, places, "place_id", "id", ["city", "state"], "place_")
    if cohorts is not None:
        inst = navigate.many_to_one(inst, cohorts, "cohort_id", "id", ["cohort_name", "schema_name"])
    return navigate.path(inst, [
        (endpoints, "endpoint_id", "id", ["api_id", "path", "method"]),
        (apis, "api_id", "id", ["name"])])


# R15 ---------------------------------------------------------------------

def link_facts(fact_relationship: DataFrame, left: DataFrame, left_domain: int, left_id: str,
               right: DataFrame, right_domain: int, right_id: str) -> DataFrame:
    """Pairs of facts linked through ``fact_relationship`` for one pair of
    domains: two equi-joins on (domain, id)."""
    fr = fact_relationship.where((F.col("domain_concept_id_1") == left_domain) &
                                 (F.col("domain_concept_id_2") == right_domain))
    a = fr.join(left.withColumnRenamed(left_id, "fact_id_1"), "fact_id_1")
    return a.join(right.withColumnRenamed(right_id, "fact_id_2"), "fact_id_2")


def event_directory(tables: dict) -> DataFrame:
    """One stacked table of everything that a link may point at: (field
    concept, event_id, event_table, *carried columns).  ``tables`` maps the
    concept id that stands for a table's key to (table name, frame, key column,
    {carried name: column}); carried names are the same for all of them."""
    parts = [df.select(F.lit(concept).alias("field_concept_id"), _q(key).cast("long").alias("event_id"), F.lit(name).alias("event_table"),
                       *[_q(c).alias(out) for out, c in sorted(carry.items())])
             for concept, (name, df, key, carry) in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def link_episode_events(links: DataFrame, directory: DataFrame, episode: DataFrame | None = None,
                        event_id: str = "event_id", field: str = "episode_event_field_concept_id") -> DataFrame:
    """``episode_event`` rows resolved.  The field concept of a link says
    which table and key its event id means, so one join on (field concept,
    event id) with the stacked directory serves links to any number of tables;
    a join per table would read the links once for each.  Links whose event
    does not exist stay, with NULL ``event_table`` and carried columns.

    With ``episode`` (its ``episode_id`` unique) its other columns are added.
    """
    take = [c for c in directory.columns if c not in ("field_concept_id", "event_id")]
    out = navigate.many_to_one(links, directory, [field, event_id], ["field_concept_id", "event_id"], take)
    if episode is not None:
        out = navigate.many_to_one(out, episode, "episode_id", "episode_id")
    return out
