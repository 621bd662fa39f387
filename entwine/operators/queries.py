"""Queries over the tables of one folder, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from entwine.functions import ids, similarity, text
from entwine.functions import values as V
from entwine.operators import extract, matching, packed, parse, registers, resolve
from entwine.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(function):
        QUERIES[name] = function
        if sql:
            SQL[name] = sql
        return function

    return keep


def projection(name: str, source: str, key: str, column: Callable[[], Column], sql: str) -> None:
    """A query of one computed column beside the table's key; columns need a session, so it is made when asked for."""
    QUERIES[name] = lambda spark, folder: table(spark, folder, source).select(key, column().alias("value"))
    SQL[name] = f"SELECT {key}, {sql} AS value FROM {source}"


# Text and identifiers, one column each.
REG, TRU, SUP = "ei_registers_normalized", "trusted_entities", "suppliers"
N, B, S = "entity_name", "raw_brand_name", "_supplier_raw_name"
projection("norm_name_matcher", REG, "row_id", lambda: text.name_for_matching(F.col(N)), text.name_for_matching_sql(N))
projection("norm_name_resolver", TRU, "row_id", lambda: text.name_for_resolving(F.col(B)), text.name_for_resolving_sql(B))
projection("norm_name_register", REG, "row_id", lambda: text.name_for_register(F.col(N)), text.name_for_register_sql(N))
projection("norm_key_roster", TRU, "row_id", lambda: text.roster_key(F.col(B)), text.roster_key_sql(B))
projection("clean_text", SUP, "row_id", lambda: text.clean_text(F.col(S)), text.clean_text_sql(S))
projection("block_key", SUP, "row_id", lambda: text.block_key(text.name_for_matching(F.col(S))), f"substring({text.name_for_matching_sql(S)}, 1, 8)")
projection("alnum_prefix", TRU, "row_id", lambda: text.letters_prefix(F.col(B)), text.letters_prefix_sql(B))
projection("meaningful_tokens", SUP, "row_id", lambda: F.array_join(F.array_sort(text.meaningful_tokens(text.name_for_matching(F.col(S)))), " "), f"array_to_string(list_sort({text.meaningful_tokens_sql(text.name_for_matching_sql(S))}), ' ')")
projection("coop_words", SUP, "row_id", lambda: text.contains_any(F.col(S), V.COOP_WORDS), text.contains_any_sql(S, V.COOP_WORDS))
projection("assoc_words", SUP, "row_id", lambda: text.contains_any(F.col(S), V.ASSOC_WORDS), text.contains_any_sql(S, V.ASSOC_WORDS))
projection("legal_form", REG, "row_id", lambda: text.legal_form(F.col(N)), text.legal_form_sql(N))
projection("legal_form_family", REG, "row_id", lambda: text.form_family(text.legal_form(F.col(N))), text.form_family_sql(f"({text.legal_form_sql(N)})"))
projection("name_triggers", REG, "row_id", lambda: F.array_join(text.triggers(F.col("country"), F.col(N)), ","), f"array_to_string({text.triggers_sql('country', N)}, ',')")
projection("tax_id_normalize", SUP, "row_id", lambda: ids.tax_key(F.col("_c3")), ids.tax_key_sql("_c3"))
projection("siren_of", SUP, "row_id", lambda: ids.siren(F.col("_c3")), ids.siren_sql("_c3"))
projection("siren_of_digits", SUP, "row_id", lambda: ids.siren_of_digits(F.col("_c3")), ids.siren_of_digits_sql("_c3"))
projection("fr_siren_sheet", SUP, "row_id", lambda: ids.siren_of_sheet(F.col("_c3")), ids.siren_of_sheet_sql("_c3"))
projection("tax_extract_es", REG, "row_id", lambda: ids.tax_es(F.col("tax_id")), ids.tax_es_sql("tax_id"))
projection("tax_extract_any", "documents", "doc_id", lambda: ids.tax_any(F.col("text")), ids.tax_any_sql("text"))
projection("tax_extract_fr", "documents", "doc_id", lambda: ids.tax_fr(F.col("text")), ids.tax_fr_sql("text"))
projection("tax_extract_it", "documents", "doc_id", lambda: ids.tax_it(F.col("text")), ids.tax_it_sql("text"))
projection("tax_root", REG, "row_id", lambda: ids.tax_root(F.col("country"), F.col("tax_id")), ids.tax_root_sql("country", "tax_id"))
ID_COLUMNS = ("country", "tax_id_root", "tax_id", "ei_register_name", "ei_registration_number", "entity_name_norm")
projection("entity_id", REG, "row_id", lambda: ids.entity_id(*map(F.col, ID_COLUMNS)), ids.entity_id_sql(*ID_COLUMNS))
projection("extract_domain", TRU, "row_id", lambda: ids.domain(F.col("website_hint")), ids.domain_sql("website_hint"))
projection("extract_domain_legacy", TRU, "row_id", lambda: ids.domain(F.col("website_hint"), True), ids.domain_sql("website_hint", True))
FILLED = ("website_hint", "business_summary", "sector")
projection("filled_count", TRU, "row_id", lambda: ids.filled(*map(F.col, FILLED)), ids.filled_sql(*FILLED))


FLAGS = ("name_coop_candidate", "name_marker_candidate", "name_candidate_reason", "name_candidate_trigger", "social_economy_name_candidate")


@query("classify_names", "SELECT row_id, " + ", ".join(f"{x} AS {c}" for c, x in text.classified_sql("supplier_country", S).items()) + f", {text.is_commercial_sql(S)} AS commercial, {text.is_brand_sql(S)} AS brand, {text.too_generic_sql(text.name_for_matching_sql(S))} AS generic FROM suppliers")
def classify_names(spark: SparkSession, folder: str) -> DataFrame:
    """Name flags, reasons and triggers of every supplier, with commercial form and brand."""
    return table(spark, folder, SUP).select("row_id", *text.classified(F.col("supplier_country"), F.col(S)), text.is_commercial(F.col(S)).alias("commercial"), text.is_brand(F.col(S)).alias("brand"), text.too_generic(text.name_for_matching(F.col(S))).alias("generic"))


@query("choose_tokens", f"SELECT row_id, array_to_string({text.chosen_tokens_sql(text.name_for_resolving_sql(B))}, ' ') AS tokens FROM trusted_entities")
def choose_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, TRU).select("row_id", F.array_join(text.chosen_tokens(text.name_for_resolving(F.col(B))), " ").alias("tokens"))


# Joins of the cascade.
def supplier_side(spark: SparkSession, folder: str, **options) -> DataFrame:
    return matching.prepared(table(spark, folder, SUP), "row_id", S, "supplier_country", "_c3", **options)


def register_side(spark: SparkSession, folder: str) -> DataFrame:
    return matching.register(table(spark, folder, REG), "row_id")


HEADER = f"lower({text.strip_sql(S)}) <> 'column2'"
FIRST = "SELECT {key} AS k, min_by(entity_name, row_id) AS name FROM ei_registers_normalized WHERE coalesce({key}, '') <> '' GROUP BY 1"


@query("tax_exact_match", f"SELECT s.row_id AS s_key, m.name AS matched FROM suppliers s JOIN ({FIRST.format(key=ids.tax_key_sql('tax_id_root'))}) m ON {ids.tax_key_sql('s._c3')} = m.k WHERE {S} IS NOT NULL AND {HEADER}")
def tax_exact_match(spark: SparkSession, folder: str) -> DataFrame:
    first = matching.first_per(register_side(spark, folder), "m_tax").withColumnRenamed("m_tax", "tax_key")
    return supplier_side(spark, folder).join(first, "tax_key").select("s_key", F.col("m.m_name").alias("matched"))


@query("siren_bridge_match", f"SELECT s.row_id AS s_key, m.name AS matched FROM suppliers s JOIN ({FIRST.format(key=ids.siren_sql('tax_id_root'))}) m ON {ids.siren_sql('s._c3')} = m.k WHERE {S} IS NOT NULL AND {HEADER}")
def siren_bridge_match(spark: SparkSession, folder: str) -> DataFrame:
    first = matching.first_per(register_side(spark, folder), "m_siren").withColumnRenamed("m_siren", "siren")
    return supplier_side(spark, folder).join(first, "siren").select("s_key", F.col("m.m_name").alias("matched"))


@query("block_counts", f"""
WITH s AS (SELECT row_id, upper({text.strip_sql("coalesce(supplier_country, '')")}) AS land, substring({text.name_for_matching_sql(S)}, 1, 8) AS block FROM suppliers WHERE {S} IS NOT NULL AND {HEADER}),
m AS (SELECT upper({text.strip_sql("country")}) AS land, substring({text.name_for_matching_sql(N)}, 1, 8) AS block, count(*) AS n FROM ei_registers_normalized WHERE {text.name_for_matching_sql(N)} <> '' GROUP BY 1, 2),
a AS (SELECT block, sum(n) AS n FROM m GROUP BY 1)
SELECT s.row_id AS s_key, m.n AS candidates FROM s JOIN m ON s.land <> '' AND s.land = m.land AND s.block = m.block
UNION ALL SELECT s.row_id, a.n FROM s JOIN a ON s.land = '' AND s.block = a.block
""")
def block_counts(spark: SparkSession, folder: str) -> DataFrame:
    """How many register rows stand in each supplier's block; counted per block before the join, so no pair is made."""
    s = supplier_side(spark, folder).select("s_key", "land", text.block_key(F.col("normal")).alias("block"))
    m = register_side(spark, folder).where("m_normal <> ''").groupBy(F.col("m_land").alias("land"), text.block_key(F.col("m_normal")).alias("block")).agg(F.count("*").alias("candidates"))
    known = s.where("land <> ''").join(m, ["land", "block"]).select("s_key", "candidates")
    return known.unionByName(s.where("land = ''").join(m.groupBy("block").agg(F.sum("candidates").alias("candidates")), "block").select("s_key", "candidates"))


KINDS = ("ratio", "token_sort_ratio", "token_set_ratio", "partial_ratio", "partial_token_ratio", "weighted_ratio")


@query("similarity_scores", f"""
WITH p AS (SELECT row_id, {text.name_for_matching_sql(N)} AS a, coalesce(entity_name_norm, '') AS b FROM ei_registers_normalized),{similarity.scores_sql('p')}
SELECT row_id, {", ".join(f"s.{k}" for k in KINDS)} FROM p JOIN scores s ON p.a = s.a AND p.b = s.b
""")
def similarity_scores(spark: SparkSession, folder: str) -> DataFrame:
    """All ratios between each register name and its normal form in the table, where both say something."""
    names = table(spark, folder, REG, "row_id", N, "entity_name_norm").select("row_id", text.name_for_matching(F.col(N)).alias("a"), F.coalesce("entity_name_norm", F.lit("")).alias("b")).where("a <> '' AND b <> ''")
    return names.select("row_id", *[similarity.score(k)("a", "b").alias(k) for k in KINDS])


def cascade_sql(brand: str) -> str:
    """The cascade; brand: whether a brand stands in the supplier's name `raw`."""
    shared = f"len(list_filter({text.meaningful_tokens_sql('b.normal')}, lambda t: list_contains({text.meaningful_tokens_sql('b.m_normal')}, t))) >= 2"
    apart = " OR ".join(f"({text.contains_any_sql('b.raw', x)} AND {text.contains_any_sql('m.m_name', y)})" for x, y in ((V.COOP_WORDS, V.ASSOC_WORDS), (V.ASSOC_WORDS, V.COOP_WORDS)))
    return f"""
WITH m AS (SELECT row_id AS m_key, entity_name AS m_name, ei_register_name AS m_register, upper({text.strip_sql('country')}) AS m_land, ccaa AS m_region, {text.name_for_matching_sql(N)} AS m_normal, {ids.tax_key_sql('tax_id_root')} AS m_tax, {ids.siren_sql('tax_id_root')} AS m_siren FROM ei_registers_normalized),
f AS (SELECT row_id AS s_key, {S} AS raw, upper({text.strip_sql("coalesce(supplier_country, '')")}) AS land, {text.name_for_matching_sql(S)} AS normal, {ids.tax_key_sql('_c3')} AS tax_key, {ids.siren_sql('_c3')} AS siren, {", ".join(f"{x} AS {c}" for c, x in text.classified_sql('supplier_country', S).items())} FROM suppliers WHERE {S} IS NOT NULL AND {HEADER}),
s AS (SELECT f.*, NOT {text.too_generic_sql('normal')} AND (NOT {text.is_commercial_sql('raw')} OR social_economy_name_candidate = 'YES' OR {brand}) AS by_name, t.m_key AS tax_hit, n.m_key AS siren_hit FROM f
  LEFT JOIN (SELECT m_tax, min(m_key) AS m_key FROM m WHERE m_tax <> '' GROUP BY 1) t ON t.m_tax = f.tax_key LEFT JOIN (SELECT m_siren, min(m_key) AS m_key FROM m WHERE m_siren <> '' GROUP BY 1) n ON n.m_siren = f.siren),
p AS (SELECT s_key, raw, normal, m_key, m_normal, normal AS a, m_normal AS b FROM s JOIN m ON m_normal <> '' AND substring(normal, 1, 8) = substring(m_normal, 1, 8) AND (land = '' OR land = m_land) WHERE by_name AND tax_hit IS NULL AND siren_hit IS NULL AND greatest(length(normal), length(m_normal)) < 1.5 * least(length(normal), length(m_normal))),{similarity.scores_sql('p', True)},
b AS (SELECT p.*, c.weighted_ratio AS score FROM p JOIN scores c ON c.a = p.a AND c.b = p.b WHERE c.weighted_ratio >= 92 QUALIFY row_number() OVER (PARTITION BY s_key ORDER BY c.weighted_ratio DESC, m_key) = 1),
z AS (SELECT b.s_key, b.m_key AS fuzzy_hit, least(99, floor(score)::INT) AS points FROM b JOIN m ON m.m_key = b.m_key WHERE NOT ({apart}) AND {shared})
SELECT s.s_key, s.raw AS _supplier_raw_name, s.land AS supplier_country, {", ".join(f"s.{c}" for c in FLAGS)}, CASE WHEN m.m_key IS NOT NULL THEN 'YES' ELSE 'NO' END AS social_enterprise_supplier, m.m_register AS matched_register, m.m_name AS matched_entity_name,
  CASE WHEN tax_hit IS NOT NULL THEN 'tax_id_exact' WHEN siren_hit IS NOT NULL THEN 'tax_id_siren_bridge' WHEN fuzzy_hit IS NOT NULL THEN 'name_fuzzy' END AS match_type, CASE WHEN tax_hit IS NOT NULL THEN 100 WHEN siren_hit IS NOT NULL THEN 98 ELSE points END::DOUBLE AS match_score, m.m_land AS match_country, m.m_region AS match_region
FROM s LEFT JOIN z ON z.s_key = s.s_key LEFT JOIN m ON m.m_key = coalesce(tax_hit, siren_hit, fuzzy_hit)
"""


@query("match_suppliers", cascade_sql(text.is_brand_sql("raw")))
def match_suppliers(spark: SparkSession, folder: str) -> DataFrame:
    """The whole cascade: one row per supplier."""
    return matching.match(supplier_side(spark, folder), register_side(spark, folder))


LISTED = "publish_status IN ('published', 'draft', 'PUBLISHED', 'DRAFT')"


@query("match_suppliers_trusted", cascade_sql(f"EXISTS (SELECT 1 FROM trusted_entities WHERE {LISTED} AND {text.strip_sql(B)} <> '' AND contains(lower(raw), lower({text.strip_sql(B)})))"))
def match_suppliers_trusted(spark: SparkSession, folder: str) -> DataFrame:
    """The cascade with the roster's published and drafted brands as whitelist: names that contain one."""
    brands = table(spark, folder, TRU, B, "publish_status").where(LISTED).select(B)
    return matching.match(supplier_side(spark, folder, brands=brands, word_boundary=False), register_side(spark, folder))


# Rosters.
SITE = r"((?:https?://|www\.)?[a-z0-9-]+(?:\.[a-z0-9-]+)+/?)"


def master_of(spark: SparkSession, folder: str) -> DataFrame:
    return resolve.with_ids(table(spark, folder, REG)).withColumn("website", F.regexp_extract("se_recognition_evidence", SITE, 1))


ROSTER_SQL = f"r AS (SELECT row_id AS r_key, {text.name_for_resolving_sql(B)} AS normal, upper({text.strip_sql("coalesce(country_hint, '')")}) AS land, {ids.domain_sql('website_hint')} AS domain FROM trusted_entities)"


def master_sql(name: str) -> str:
    return f"m AS (SELECT row_id AS ord, {ids.entity_id_sql(*ID_COLUMNS)} AS id, entity_name AS name, {text.name_for_resolving_sql(name)} AS m_normal, upper({text.strip_sql("coalesce(country, '')")}) AS land, {ids.domain_sql(f"regexp_extract(se_recognition_evidence, '{SITE}', 1)")} AS domain FROM ei_registers_normalized)"


def tops_sql(pairs: str, k: int = 5) -> str:
    """CTEs scores, x (pairs with score and rank) and t (r_key, best, id, listed) for a CTE with r_key, ord, id, name, normal, m_normal."""
    return f"""{similarity.scores_sql(pairs + '_ab', True)},
x AS (SELECT q.*, coalesce(weighted_ratio, 0) AS score, row_number() OVER (PARTITION BY r_key ORDER BY coalesce(weighted_ratio, 0) DESC, ord) AS rank FROM {pairs} q LEFT JOIN scores ON scores.a = normal AND scores.b = m_normal WHERE m_normal <> ''),
t AS (SELECT r_key, max(score) AS best, max(id) FILTER (WHERE rank = 1) AS id, string_agg(concat_ws('|', id, coalesce(name, ''), score::VARCHAR), '; ' ORDER BY rank) AS listed FROM x WHERE rank <= {k} GROUP BY 1)"""


BY_DOMAIN = f"""
WITH {ROSTER_SQL}, {master_sql(N)},
d AS (SELECT land, domain, count(*) AS n, min_by(id, ord) AS lone FROM m WHERE domain <> '' GROUP BY ALL), c AS (SELECT land, count(*) AS in_land FROM m GROUP BY 1),
k AS (SELECT r.*, n, lone, in_land, coalesce(n BETWEEN 1 AND 25, false) AS few FROM r LEFT JOIN d ON d.land = r.land AND d.domain = r.domain LEFT JOIN c ON c.land = r.land),
q AS (SELECT k.r_key, k.normal, m.ord, m.id, m.name, m.m_normal FROM k JOIN m ON m.land = k.land AND (NOT k.few OR m.domain = k.domain) WHERE k.normal <> '' AND coalesce(n, 0) <> 1),
q_ab AS (SELECT DISTINCT normal AS a, m_normal AS b FROM q),{tops_sql('q')},
z AS (SELECT k.*, best, id, listed, CASE WHEN normal = '' AND domain = '' THEN 'empty' WHEN few AND n = 1 THEN 'domain_exact' WHEN few AND best >= 92 THEN 'domain+fuzzy' WHEN few THEN 'domain_ambiguous'
  WHEN normal = '' OR in_land IS NULL THEN 'no_country_index' WHEN best IS NULL THEN 'no_candidates' WHEN best >= 92 THEN 'fuzzy_country' ELSE 'fuzzy_below_threshold' END AS how FROM k LEFT JOIN t ON t.r_key = k.r_key)
"""


@query("resolve_v1", BY_DOMAIN + """
SELECT r_key, CASE WHEN how = 'domain_exact' THEN lone WHEN how IN ('domain+fuzzy', 'fuzzy_country') THEN id END AS entity_id, how AS match_method, CASE how WHEN 'domain_exact' THEN 100.0 WHEN 'domain_ambiguous' THEN coalesce(best, 0.0) ELSE best END::DOUBLE AS match_score,
  CASE WHEN how IN ('empty', 'no_country_index') OR few THEN n ELSE in_land END::DOUBLE AS match_candidate_count, how NOT IN ('domain_exact', 'domain+fuzzy', 'fuzzy_country') AS needs_review, CASE WHEN how IN ('domain_ambiguous', 'fuzzy_below_threshold') THEN listed END AS candidates FROM z
""")
def resolve_v1(spark: SparkSession, folder: str) -> DataFrame:
    """Roster rows resolved by web domain, then by name within the country."""
    return resolve.resolve_by_domain(table(spark, folder, TRU), master_of(spark, folder), "website")


@query("review_queue_v1", BY_DOMAIN + """
SELECT r_key, how AS match_method, CASE how WHEN 'domain_ambiguous' THEN concat('Domain matched ', n, ' candidates; none cleared threshold 92') ELSE concat('Best score ', best::VARCHAR, ' below threshold 92') END AS notes, listed AS candidates FROM z WHERE how IN ('domain_ambiguous', 'fuzzy_below_threshold')
""")
def review_queue_v1(spark: SparkSession, folder: str) -> DataFrame:
    return resolve.review_by_domain(resolve_v1(spark, folder))


BY_BLOCKS = f"""
WITH {ROSTER_SQL}, {master_sql('entity_name_norm')},
k AS (SELECT *, {text.letters_prefix_sql('normal')} AS block, {text.chosen_tokens_sql('normal')} AS tokens FROM r WHERE land <> '' AND normal <> ''),
g AS (SELECT *, {text.letters_prefix_sql('m_normal')} AS block FROM m),
c AS (SELECT land, count(*) AS in_land FROM g GROUP BY 1), n AS (SELECT land, block, count(*) AS in_block FROM g WHERE block <> '' GROUP BY ALL),
e AS (SELECT k.*, coalesce(in_block, 0) AS in_block FROM k LEFT JOIN n ON n.land = k.land AND n.block = k.block),
q AS (SELECT e.r_key, e.normal, g.ord, g.id, g.name, g.m_normal FROM e JOIN g ON g.land = e.land AND ((g.block = e.block AND g.block <> '') OR (e.in_block < 50 AND (len(e.tokens) = 0 OR contains(g.m_normal, e.tokens[1]))))),
u AS (SELECT r_key, count(*) AS candidates FROM q GROUP BY 1),
q_ab AS (SELECT DISTINCT normal AS a, m_normal AS b FROM q),{tops_sql('q')},
z AS (SELECT r.*, candidates, in_land, best, id, listed, CASE WHEN r.land = '' OR r.normal = '' THEN 'missing_country_or_name' WHEN in_land IS NULL THEN 'no_master_for_country' WHEN candidates IS NULL THEN 'no_candidates' WHEN best IS NULL THEN 'no_match'
  WHEN best >= 92 THEN 'fuzzy_blocked' ELSE 'below_threshold' END AS how FROM r LEFT JOIN c ON c.land = r.land LEFT JOIN u ON u.r_key = r.r_key LEFT JOIN t ON t.r_key = r.r_key)
"""


@query("resolve_v2", BY_BLOCKS + """
SELECT r_key, CASE WHEN how = 'fuzzy_blocked' THEN id END AS entity_id, how AS match_method, best AS match_score, CASE WHEN how NOT IN ('missing_country_or_name', 'no_master_for_country') THEN coalesce(candidates, 0) END::DOUBLE AS candidate_count, how <> 'fuzzy_blocked' AS needs_review,
  CASE WHEN how = 'below_threshold' THEN best END AS best_score, CASE WHEN how = 'below_threshold' THEN listed END AS top_candidates FROM z
""")
def resolve_v2(spark: SparkSession, folder: str) -> DataFrame:
    """Roster rows resolved by blocks of country and first letters, widened by tokens."""
    return resolve.resolve_by_blocks(table(spark, folder, TRU), master_of(spark, folder))


@query("review_queue_v2", BY_BLOCKS + "SELECT r_key, NULL::VARCHAR AS notes, best AS best_score, listed AS top_candidates FROM z WHERE how = 'below_threshold'")
def review_queue_v2(spark: SparkSession, folder: str) -> DataFrame:
    return resolve.review_by_blocks(resolve_v2(spark, folder))


@query("resolve_rate", BY_BLOCKS + "SELECT count(*) FILTER (WHERE how = 'fuzzy_blocked') AS resolved, count(*) AS total FROM z")
def resolve_rate(spark: SparkSession, folder: str) -> DataFrame:
    """How many roster rows resolve_v2 resolves; names below its threshold change no count and are not ranked."""
    return resolve.resolve_by_blocks(table(spark, folder, TRU), master_of(spark, folder), k=1, least=92.0).agg(F.count_if(~F.col("needs_review")).alias("resolved"), F.count("*").alias("total"))


@query("domain_join", f"""
WITH t AS (SELECT row_id, upper({text.strip_sql("coalesce(country_hint, '')")}) AS land, {ids.domain_sql('website_hint')} AS d FROM trusted_entities),
m AS (SELECT DISTINCT upper({text.strip_sql("country")}) AS land, {ids.domain_sql('se_recognition_evidence')} AS d FROM ei_registers_normalized)
SELECT t.row_id, t.d AS domain FROM t JOIN m ON t.land = m.land AND t.d = m.d WHERE t.d <> '' AND t.land <> ''
""")
def domain_join(spark: SparkSession, folder: str) -> DataFrame:
    t = table(spark, folder, TRU).select("row_id", F.upper(text.strip(F.coalesce("country_hint", F.lit("")))).alias("land"), ids.domain(F.col("website_hint")).alias("domain")).where("domain <> '' AND land <> ''")
    m = table(spark, folder, REG).select(F.upper(text.strip(F.col("country"))).alias("land"), ids.domain(F.col("se_recognition_evidence")).alias("domain")).distinct()
    return t.join(m, ["land", "domain"]).select("row_id", "domain")


ROSTER = ("row_id", B, "website_hint", "business_summary", "sector")


DIRECTORY_SQL = r"regexp_replace(upper(trim(coalesce(source, ''))), '[\s_-]+', '_', 'g') = 'DIRECTORY_V22'"


@query("roster_rebuild", f"""
WITH u AS (SELECT row_id, CASE WHEN {DIRECTORY_SQL} THEN 1 ELSE 2 END AS priority, {ids.filled_sql('website_hint', 'business_summary', 'sector')} AS filled, {text.roster_key_sql(B)} AS k FROM trusted_entities)
SELECT k AS roster_key, row_id, priority, filled FROM u WHERE k <> '' QUALIFY row_number() OVER (PARTITION BY k ORDER BY priority DESC, filled DESC, row_id) = 1
""")
def roster_rebuild(spark: SparkSession, folder: str) -> DataFrame:
    """Roster and directory made one; the better row of each name stays. Rows of the directory, however its name is written, are one part, all others the roster."""
    rows = table(spark, folder, TRU, *ROSTER, "source").withColumn("_listed", F.regexp_replace(F.upper(F.trim(F.coalesce("source", F.lit("")))), r"[\s_-]+", "_") == "DIRECTORY_V22")
    parts = [(rows.where(w).select(*ROSTER), p) for w, p in (("NOT _listed", 2), ("_listed", 1))]
    return resolve.rebuild_roster(parts).select("roster_key", "row_id", "priority", "filled")


@query("first_wins_distinct", "SELECT country, entity_name, postcode, min(row_id) AS row_id FROM ei_registers_normalized GROUP BY ALL")
def first_wins_distinct(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, REG, "row_id", "country", N, "postcode").groupBy("country", N, "postcode").agg(F.min("row_id").alias("row_id"))


@query("country_semi", "SELECT row_id FROM ei_registers_normalized WHERE country IN (SELECT upper(country_hint) FROM trusted_entities)")
def country_semi(spark: SparkSession, folder: str) -> DataFrame:
    lands = table(spark, folder, TRU, "country_hint").select(F.upper("country_hint").alias("country")).distinct()
    return table(spark, folder, REG, "row_id", "country").join(lands, "country", "left_semi").select("row_id")


@query("unresolved_anti", f"SELECT row_id FROM suppliers WHERE {ids.tax_key_sql('_c3')} NOT IN (SELECT {ids.tax_key_sql('tax_id_root')} FROM ei_registers_normalized WHERE {ids.tax_key_sql('tax_id_root')} <> '')")
def unresolved_anti(spark: SparkSession, folder: str) -> DataFrame:
    keys = table(spark, folder, REG, "tax_id_root").select(ids.tax_key(F.col("tax_id_root")).alias("k")).where("k <> ''").distinct()
    return table(spark, folder, SUP, "row_id", "_c3").withColumn("k", ids.tax_key(F.col("_c3"))).join(keys, "k", "left_anti").select("row_id")


# Registers.
@query("apply_mapping", "SELECT _supplier_raw_name AS entity_name, _c3 AS tax_id, supplier_country AS country FROM suppliers")
def apply_mapping(spark: SparkSession, folder: str) -> DataFrame:
    mapping = {"entity_name": ["Name", "_SUPPLIER_RAW_NAME"], "tax_id": ["_c3", "_c0"], "country": ["supplier_country"], "city": ["missing"], "province": []}
    return registers.apply_mapping(table(spark, folder, SUP), mapping)


@query("metadata_fill", "SELECT row_id, 'XX' AS country, source FROM trusted_entities")
def metadata_fill(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, TRU, "row_id", "source").withColumn("country", F.lit(None).cast("string"))
    return registers.filled_in(rows, {"country": "XX", "source": "unused"}).select("row_id", "country", "source")


def catalogue_run(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    def failing(spark: SparkSession, source: dict) -> DataFrame:
        raise ValueError("no such file")

    readers = {"TABLE": lambda s, x: table(s, folder, x["url"]), "CSV": failing}
    catalogue = [
        {"country": "ES", "type": "TABLE", "name": "Suppliers", "url": SUP, "mapping": {"entity_name": [S], "tax_id": ["_c3"]}},
        {"country": "FR", "type": "TABLE", "name": "Roster", "url": TRU, "mapping": {"entity_name": [B]}},
        {"country": "IT", "type": "CSV", "name": "Broken", "url": "x.csv"},
        {"country": "PT", "type": "TABLE", "name": "Off", "url": SUP, "enabled": False},
    ]
    return registers.run(spark, catalogue, readers, "2024-01-31")


@query("canonical_union", f"""
SELECT 'ES' AS country, {text.clean_text_sql(S)} AS entity_name, {ids.tax_es_sql('_c3')} AS tax_id, nullif({ids.tax_es_sql('_c3')}, '') AS tax_id_root, {text.legal_form_sql(S)} AS legal_form_local, 'Suppliers' AS ei_register_name FROM suppliers
UNION ALL SELECT 'FR', {text.clean_text_sql(B)}, NULL, NULL, {text.legal_form_sql(B)}, 'Roster' FROM trusted_entities
""")
def canonical_union(spark: SparkSession, folder: str) -> DataFrame:
    """Two sources mapped, completed and united."""
    return catalogue_run(spark, folder)[0].select("country", N, "tax_id", "tax_id_root", "legal_form_local", "ei_register_name")


@query("run_report", f"""
SELECT '2024-01-31' AS run_date, 1 AS source_index, 'ES' AS country, NULL::VARCHAR AS ccaa, 'TABLE' AS source_type, 'Suppliers' AS ei_register_name, 'suppliers' AS source_url, 'OK' AS status, (SELECT count(*) FROM suppliers) AS rows_extracted, NULL::VARCHAR AS error
UNION ALL SELECT '2024-01-31', 2, 'FR', NULL, 'TABLE', 'Roster', 'trusted_entities', 'OK', (SELECT count(*) FROM trusted_entities), NULL UNION ALL SELECT '2024-01-31', 3, 'IT', NULL, 'CSV', 'Broken', 'x.csv', 'ERROR', 0, 'no such file'
""")
def run_report(spark: SparkSession, folder: str) -> DataFrame:
    return catalogue_run(spark, folder)[1]


@query("rows_per_source", "SELECT ei_register_name, count(*) AS n FROM ei_registers_normalized GROUP BY 1")
def rows_per_source(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, REG, "ei_register_name").groupBy("ei_register_name").agg(F.count("*").alias("n"))


@query("ess_filter", "SELECT o_orderkey, o_orderpriority FROM orders WHERE upper(o_orderstatus) = 'O'")
def ess_filter(spark: SparkSession, folder: str) -> DataFrame:
    units = table(spark, folder, "orders").withColumnRenamed("o_orderstatus", "economieSocialeSolidaireUniteLegale")
    return units.where(F.upper("economieSocialeSolidaireUniteLegale") == "O").select("o_orderkey", "o_orderpriority")


# Extraction, from the lines of the documents.
@query("text_lines", r"""
WITH l AS (SELECT doc_id AS doc, unnest(generate_series(0, len(regexp_split_to_array(text, '\r?\n')) - 1)) AS pos, unnest(regexp_split_to_array(text, '\r?\n')) AS line FROM documents)
SELECT doc, pos::INT AS pos, """ + text.chain_sql(text.strip_sql("line"), [(r"[\s\p{Z}]+", " ")]) + " AS line FROM l WHERE " + text.strip_sql("line") + " <> ''")
def text_lines(spark: SparkSession, folder: str) -> DataFrame:
    return extract.lines(table(spark, folder, "documents"), "doc_id", "text")


@query("line_fold", r"""
WITH l AS (SELECT doc_id AS doc, unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) AS pos, unnest(string_split(text, chr(10))) AS line FROM documents),
g AS (SELECT doc, sum(CASE WHEN length(line) % 3 = 0 OR pos = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY doc ORDER BY pos) AS island FROM l)
SELECT doc, island::BIGINT AS island, count(*) AS n FROM g GROUP BY ALL
""")
def line_fold(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of lines, each begun by a marked line."""
    rows = table(spark, folder, "documents").select(F.col("doc_id").alias("doc"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    start = F.when((F.length("line") % 3 == 0) | (F.col("pos") == 0), 1).otherwise(0)
    island = F.sum(start).over(Window.partitionBy("doc").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return rows.select("doc", island.alias("island")).groupBy("doc", "island").agg(F.count("*").alias("n"))


@query("json_values", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_values(spark: SparkSession, folder: str) -> DataFrame:
    items = extract.json_items(table(spark, folder, "events", "event_id", "props"), "event_id", "props")
    return items.select(F.col("doc").alias("event_id"), F.get_json_object("item", "$.k").cast("bigint").alias("k"))


@query("paginate_urls", """
SELECT source_index, address FROM (SELECT source_index, source_url AS address FROM run_report WHERE source_url IS NOT NULL
UNION ALL SELECT source_index, concat(rtrim(source_url, '/'), '/page/', unnest(generate_series(2, 4)), '/') FROM run_report WHERE source_url IS NOT NULL)
""")
def paginate_urls(spark: SparkSession, folder: str) -> DataFrame:
    sources = table(spark, folder, "run_report", "source_index", "source_url").where("source_url IS NOT NULL").withColumns({"first": F.lit(1), "last": F.lit(4)})
    return extract.page_addresses(sources, F.col("source_url"), "first", "last").select("source_index", "address")


# Data pipeline.
@query("p2_found")
def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """One row per value packed in identified_clients and sector."""
    return packed.unpack(table(spark, folder, TRU, "row_id", "identified_clients", "sector"), "row_id", ["identified_clients", "sector"])


ROSTER_FILE = (B, "country_hint", "website_hint", "trusted_reason", "publish_status", "source", "updated_on")
FIELD = r'(?:"(?:[^"]|"")*"|[^"\x1f]*)'
#: Lines with their separator as \x1f, so that one pattern fits all files; v: value by column name, null where the file lacks it.
LINES_SQL = rf"""
WITH h AS (SELECT file_name, regexp_replace(min_by(raw_line, line_id), '\r$', '') AS header FROM raw_roster_lines WHERE line_no = 1 GROUP BY 1),
s AS (SELECT *, coalesce(nullif(substring(regexp_replace(header, '[^,;|\t]', '', 'g'), 1, 1), ''), ',') AS sep FROM h),
f AS (SELECT file_name, sep, list_transform(regexp_extract_all(chr(31) || replace(header, sep, chr(31)), '\x1f({FIELD})', 1), lambda x: trim(CASE WHEN x[1] = '"' THEN replace(x[2:-2], '""', '"') ELSE x END)) AS names FROM s),
l AS (SELECT line_id, file_name, line_no, names, coalesce(sep, ',') AS sep, replace(regexp_replace(raw_line, '\r$', ''), coalesce(sep, ','), chr(31)) AS line FROM raw_roster_lines LEFT JOIN f USING (file_name) WHERE line_no IS NULL OR line_no <> 1),
c AS (SELECT *, list_transform(regexp_extract_all(chr(31) || line, '\x1f({FIELD})', 1), lambda x: replace(CASE WHEN x[1] = '"' THEN replace(x[2:-2], '""', '"') ELSE x END, chr(31), sep)) AS fields FROM l),
k AS (SELECT *, CASE WHEN line IS NULL OR names IS NULL THEN 'column_count' WHEN NOT regexp_full_match(line, '{FIELD}(?:\x1f{FIELD})*') THEN 'quoting' WHEN len(fields) <> len(names) THEN 'column_count' END AS shape FROM c),
v AS (SELECT line_id, file_name, line_no, shape, {", ".join(f"fields[nullif(list_position(names, '{x}'), 0)] AS {x}" for x in ROSTER_FILE)} FROM k),
r AS (SELECT *, coalesce(shape, CASE WHEN NOT coalesce(regexp_matches({B}, '\p{{L}}'), true) OR NOT coalesce(website_hint = '' OR regexp_full_match(website_hint, '(?i:https?://)?[\p{{L}}\p{{N}}-]+(?:\.[\p{{L}}\p{{N}}-]+)+(?::\d+)?(?:/\S*)?'), true)
  OR NOT coalesce(lower(publish_status) IN ('', 'published', 'draft'), true) OR NOT coalesce(updated_on = '' OR (regexp_full_match(updated_on, '\d{{4}}-\d{{2}}-\d{{2}}') AND try_cast(updated_on AS DATE) IS NOT NULL), true) THEN 'invalid_value' END) AS reason FROM v)
"""


@query("p6_found", LINES_SQL + "SELECT line_id, reason FROM r WHERE reason IS NOT NULL")
def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Roster lines that are no valid record, with the reason."""
    return parse.rejected(parse.parse_lines(table(spark, folder, "raw_roster_lines")), parse.ROSTER_RULES).select("line_id", "reason")


@query("p6_rows", LINES_SQL + f"SELECT line_id, file_name, line_no, {', '.join(ROSTER_FILE)} FROM r WHERE reason IS NULL")
def p6_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The valid roster lines as rows."""
    lines = parse.parse_lines(table(spark, folder, "raw_roster_lines"))
    return parse.accepted(lines, parse.rejected(lines, parse.ROSTER_RULES), list(ROSTER_FILE))
