"""Driver queries of the corpus operators, one per operator, over whole tables."""
from __future__ import annotations

from pyspark.sql import functions as F

from . import bpe, infill, jaccard, language, licenses, lm, mixing, packing, quality, resample, secrets, sharding, vectors
from .common import table


# 1 -----------------------------------------------------------------------
def coded_digests(coded):
    """The ids and the text decoded from them, as counts and digests."""
    return bpe.decode(coded).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op1_bpe_roundtrip(spark, d):
    return coded_digests(bpe.encode(table(spark, d, "documents").select("doc_id", "text")))


# 2 -----------------------------------------------------------------------
def op2_mix_sources(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source")
    return mixing.mix(docs, apart=F.monotonically_increasing_id())  # of a scan: the same in every reading


_OP2_SQL = """
WITH RECURSIVE n AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
k AS (SELECT count(*) AS k, sum(n)::HUGEINT AS al FROM n),
w AS (SELECT source, n, row_number() OVER (ORDER BY source NULLS FIRST) AS i, (3 * k * n + al)::HUGEINT AS w, k
      FROM n, k),
b AS (SELECT *, 1 + (w * (1000 - k)) // sum(w) OVER () AS base, (w * (1000 - k)) % sum(w) OVER () AS rest
      FROM (SELECT * REPLACE (w::HUGEINT AS w, k::HUGEINT AS k) FROM w)),
tk AS (SELECT source, n, i, (base + CASE WHEN row_number() OVER (ORDER BY rest DESC, i) <= 1000 - sum(base) OVER ()
                                         THEN 1 ELSE 0 END)::BIGINT AS a FROM b),
av AS (SELECT list(a ORDER BY i) AS av FROM tk),
s(t, given, p) AS (
  SELECT -1::BIGINT, list_transform(av, lambda x: 0::BIGINT), NULL::BIGINT FROM av
  UNION ALL
  SELECT t + 1, list_transform(given, lambda g, i: g + CASE WHEN i = q THEN 1 ELSE 0 END), q
  FROM (SELECT t, given, list_min(list_transform(
          list_filter(range(1, len(av) + 1), lambda i: given[i] < av[i] AND given[i] * 1000 // av[i] <= t + 1),
          lambda i: {'d': ((given[i] + 1) * 1000 + av[i] - 1) // av[i], 'i': i})).i AS q
        FROM s, av WHERE t < 999)),
sl AS (SELECT p AS i, list(t ORDER BY t) AS slots FROM s WHERE p IS NOT NULL GROUP BY p),
pl AS (SELECT tk.*, slots, ((n - 1) // 8) // a * 1000 + slots[((n - 1) // 8) % a + 1] AS stop FROM tk JOIN sl USING (i)),
pr AS (SELECT *, ((m // 1000) * a + len(list_filter(slots, lambda x: x <= m % 1000))) * 8 AS rows
       FROM (SELECT *, max(stop) OVER () AS m FROM pl)),
r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5(coalesce(doc_id::VARCHAR, ''))) - 1 AS r
      FROM documents),
e AS (SELECT doc_id, r.source, r, n, a, slots, unnest(range(0, (rows - 1 - r) // n + 1)) AS epoch
      FROM r JOIN pr ON r.source IS NOT DISTINCT FROM pr.source)
SELECT doc_id, source, epoch, (epoch * n + r) // 8 AS block,
       ((epoch * n + r) // 8) // a * 1000 + slots[((epoch * n + r) // 8) % a + 1] AS slot,
       ((epoch * n + r) % 8)::INTEGER AS place
FROM e
"""


# 3 -----------------------------------------------------------------------
def op3_embedding_neardup(spark, d):
    return vectors.near_duplicates(table(spark, d, "embeddings"))


# 4 -----------------------------------------------------------------------
def licence_columns(found):
    return found.select("doc_id", F.size("sentence_ids").cast("long").alias("n_sentences"),
                        F.array_join("sentence_ids", ",").alias("sentence_ids"),
                        F.array_join("rules", ",").alias("rules"),
                        F.array_join("licenses", ",").alias("licenses"), "license", "verdict")


def op4_license_scan(spark, d):
    return licence_columns(licenses.scan_licenses(table(spark, d, "documents")))


def _quoted(items) -> str:
    return "[" + ", ".join("'" + x + "'" for x in items) + "]"


def _op4_sql() -> str:
    def pick(column):
        return ", ".join(f"CASE WHEN regexp_matches(line, '{licenses.ordered_pattern(ids)}') THEN '{rule[column]}' END"
                         for *rule, ids in licenses.RULES)

    def first(column):
        return "CASE " + " ".join(f"WHEN regexp_matches(line, '{licenses.ordered_pattern(ids)}') THEN '{rule[column]}'"
                                  for *rule, ids in licenses.RULES) + " END"

    def ids_of(names, what):
        return f"list_transform({what}, lambda p: ({_quoted(names.values())})[list_position({_quoted(names)}, p)])"
    # ends of sentences are doubled, as the pattern has no look-around: each sentence takes one of a pair
    whole, tagged = licenses.wordings("(?: |~~)")
    names = {t: i for t, i in licenses.SENTENCES.items() if i.startswith("name_")}
    alone = {t: i for t, i in licenses.SENTENCES.items() if not i.startswith("name_")}
    tag = f"{licenses.TAG}(?:~~|[|][|])"
    hint = licenses.HINT.replace(" ", "[^a-zA-Z0-9]+")
    return f"""
WITH t AS (SELECT doc_id, CASE WHEN regexp_matches(text, '{hint}') THEN regexp_replace(chr(10) ||
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '\n[^a-z0-9\n]+', chr(10), 'g') ELSE '' END AS low FROM documents),
p AS (SELECT doc_id, regexp_replace(regexp_replace(low, '[.!?;:]([ \t\r\n])', chr(10) || chr(10) || '\1', 'g'), '[^a-z0-9\n]+', ' ', 'g') AS low FROM t),
n AS (SELECT doc_id, '||' || regexp_replace(regexp_replace(trim(low, ' '), '[ \n]*\n ?\n[ \n]*', '||', 'g'), ' ?\n ?', '~~', 'g') || '||' AS line FROM p),
f AS (SELECT doc_id, list_transform(regexp_extract_all(line, '[|~](?:{tag}{tagged}|{whole})[|~]'), lambda s: s[2:-2]) AS found FROM n),
s AS (SELECT doc_id, flatten(list_transform(found, lambda s: CASE WHEN regexp_matches(s, '^{tag}.') THEN
        [['spdx_tag'], CASE WHEN list_contains({_quoted(names)}, replace(regexp_replace(s, '^{tag}', ''), '~~', ' '))
         THEN {ids_of(names, "[replace(regexp_replace(s, '^" + tag + "', ''), '~~', ' ')]")}
         ELSE ['choice'] || {ids_of(names, "string_split_regex(replace(regexp_replace(s, '^" + tag + "', ''), '~~', ' '), ' (?:or|and) ')")} END]
      WHEN list_contains({_quoted(alone)}, replace(s, '~~', ' ')) THEN [{ids_of(alone, "[replace(s, '~~', ' ')]")}]
      ELSE [[replace(s, '~~', ' ')]] END)) AS ids FROM f),
b AS (SELECT doc_id, list_transform(ids, lambda x: CASE WHEN regexp_matches(x[1], '{licenses.AROUND[0]}') THEN
        regexp_replace(regexp_replace(x[1], '{licenses.AROUND[0]}', ''), '{licenses.AROUND[1]}', '') END) AS bare, ids FROM s),
i AS (SELECT doc_id, flatten(list_transform(range(1, len(ids) + 1), lambda k: CASE WHEN bare[k] IS NULL THEN ids[k]
        WHEN list_contains({_quoted(licenses.NOTICES)}, bare[k]) THEN {ids_of(licenses.NOTICES, "[bare[k]]")}
        ELSE ['choice'] || {ids_of(licenses.NOTICES, "string_split_regex(bare[k], '" + licenses.BETWEEN + "')")} END)) AS ids FROM b),
l AS (SELECT doc_id, ids, ' ' || coalesce(array_to_string(ids, '  '), '') || ' ' AS line FROM i)
SELECT doc_id, coalesce(len(ids), 0)::BIGINT AS n_sentences, coalesce(array_to_string(ids, ','), '') AS sentence_ids,
       coalesce(array_to_string(list_filter([{pick(0)}], lambda x: x IS NOT NULL), ','), '') AS rules,
       coalesce((SELECT string_agg(x, ',' ORDER BY j) FROM (
          SELECT x, min(j) AS j FROM (SELECT unnest([{pick(1)}]) AS x, unnest(range({len(licenses.RULES)})) AS j)
          WHERE x IS NOT NULL GROUP BY x)), '') AS licenses,
       {first(1)} AS license, {first(2)} AS verdict
FROM l
"""


# 5 -----------------------------------------------------------------------
def op5_shard_jump(spark, d):
    return sharding.shard_documents(table(spark, d, "documents"), 8)


# 6 -----------------------------------------------------------------------
def op6_secret_scan(spark, d):
    found = secrets.scan_secrets(table(spark, d, "documents").select("doc_id", "text"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                     s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE))
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                        count("hex").alias("n_hex"), F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"), count("novel").alias("n_novel"))


# 7 -----------------------------------------------------------------------
def op7_quality_hosts(spark, d):
    measured = quality.measure(table(spark, d, "documents").select("doc_id", "source", "text")).drop("text")
    judged = quality.verdicts(measured)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "n_failed", "host_rejects")


def quality_sql(documents: str = "documents") -> str:
    """DuckDB statement for the judged rows of a table, with ``rid`` per row."""
    rates = ",\n".join(
        f"avg(f_{r} / n) OVER () AS m_{r}, var_pop(f_{r} / n) OVER () AS v_{r}" for r in quality.RULES)
    strict = ", ".join(
        f"(f_{r} + m_{r} * s_{r}) / (n + s_{r}) >= {quality.HOST_LIMIT} AS strict_{r}" for r in quality.RULES)
    strength = ", ".join(
        f"CASE WHEN v_{r} > 0 AND m_{r} * (1 - m_{r}) / v_{r} - 1 > 0 THEN m_{r} * (1 - m_{r}) / v_{r} - 1 ELSE nn END AS s_{r}"
        for r in quality.RULES)
    fails = ", ".join(f"sum(({rule})::INT)::DOUBLE AS f_{r}" for r, rule in quality.RULES.items())
    rejects = " OR ".join(f"(({rule}) AND strict_{r})" for r, rule in quality.RULES.items())
    n_failed = " + ".join(f"({rule})::INT" for rule in quality.RULES.values())
    return f"""
WITH d AS (SELECT *, coalesce(text, '') AS t, row_number() OVER () AS rid FROM {documents}),
w AS (SELECT rid, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
win AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
        FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
rep AS (SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
cov AS (SELECT rid, count(DISTINCT p) AS r FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY rid),
m AS (SELECT d.*, len(ws)::BIGINT AS n_words, len(ls)::BIGINT AS n_lines,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(r, 0)::BIGINT AS n_repeat_words,
             length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols
      FROM d JOIN w USING (rid) LEFT JOIN cov USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
h AS (SELECT source, count(*)::DOUBLE AS n, {fails} FROM b GROUP BY source),
h2 AS (SELECT *, avg(n) OVER () AS nn, {rates} FROM h),
h3 AS (SELECT *, {strength} FROM h2),
h4 AS (SELECT source AS host, {strict} FROM h3),
j AS (SELECT b.*, {n_failed} AS n_failed, {rejects} AS host_rejects
      FROM b JOIN h4 ON b.source IS NOT DISTINCT FROM host),
judged AS (SELECT *, NOT base_failed AND NOT host_rejects AND n_failed < 2 AS kept FROM j)
"""


_OP7_SQL = quality_sql() + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_failed, host_rejects
FROM judged
"""

# 8 -----------------------------------------------------------------------
def op8_ngram_jaccard(spark, d):
    joined = jaccard.join_documents(table(spark, d, "documents").select("doc_id", "text"))
    return joined.select("doc_id", F.col("component_id").alias("class_id"), "n_links", "n_shingles", "kept")


# 9 -----------------------------------------------------------------------
def op9_context_mixing(spark, d):
    return lm.score_documents(table(spark, d, "documents").select("doc_id", "text"))


# 10 ----------------------------------------------------------------------
def op10_pack_ids(spark, d):
    return packing.pack_documents(table(spark, d, "documents"))


# 11 ----------------------------------------------------------------------
def op11_fill_in_middle(spark, d):
    made = infill.restore(infill.infill(table(spark, d, "documents").select("doc_id", "text")))
    return made.select("doc_id", F.col("n_chars").alias("n"), "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


# 12 ----------------------------------------------------------------------
def op12_language_id(spark, d):
    return language.identify(table(spark, d, "documents").select("doc_id", "text", "lang")).drop("lang")


# 13 ----------------------------------------------------------------------
def op13_resample_target(spark, d):
    drawn = resample.resample(table(spark, d, "documents").select("doc_id", "text"), table(spark, d, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {f.__name__: f for f in (op1_bpe_roundtrip, op2_mix_sources, op3_embedding_neardup, op4_license_scan, op5_shard_jump, op6_secret_scan,
                                   op7_quality_hosts, op8_ngram_jaccard, op9_context_mixing, op10_pack_ids, op11_fill_in_middle,
                                   op12_language_id, op13_resample_target)}

ORACLE_SQL = {
    "op2_mix_sources": _OP2_SQL,
    "op4_license_scan": _op4_sql(),
    "op7_quality_hosts": _OP7_SQL,
}
