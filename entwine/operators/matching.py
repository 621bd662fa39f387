"""Suppliers matched with a register: tax number, SIREN, then blocked fuzzy names with vetoes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entwine.functions import ids, text
from entwine.functions import values as V
from entwine.operators.nearest import nearest
from entwine.plans.durable import durable, shuffled, small_side

OUTPUT = ("social_enterprise_supplier", "matched_register", "matched_entity_name", "match_type", "match_score", "match_country", "match_region")


def column_of(df: DataFrame, at: int | str) -> str:
    """A column by name, or by ordinal as a number or digits; a clear error if it is missing."""
    if isinstance(at, str) and at in df.columns:
        return at
    if isinstance(at, int) or at.isdigit():
        if int(at) < len(df.columns):
            return df.columns[int(at)]
    raise ValueError(f"no column {at!r} among {df.columns}")


def prepared(suppliers: DataFrame, key: str, name: str, country: str | None, tax: str | None, brands: tuple[str, ...] | DataFrame = V.SOCIAL_BRANDS, word_boundary: bool = True) -> DataFrame:
    """Suppliers with a name, without leaked header cells, with the name's flags and the keys of each stage.

    Columns: s_key, raw, land, normal, tax_key, siren, the five of text.classified(), and by_name (open to the fuzzy
    stage). brands: those that let a commercial name in; a table with one column for a whole roster of them.
    """
    raw, land = F.col(name), F.upper(text.strip(F.coalesce(F.col(country), F.lit("")))) if country else F.lit("")
    kept = suppliers.where(raw.isNotNull() & (F.lower(text.strip(raw)) != "column2"))
    number = F.col(tax) if tax else F.lit(None).cast("string")
    base = kept.select(F.col(key).alias("s_key"), raw.alias("raw"), land.alias("land"), text.name_for_matching(raw).alias("normal"), ids.tax_key(number).alias("tax_key"), ids.siren(number).alias("siren"))
    flags = base.select("*", *text.classified(F.col("land"), F.col("raw")))
    if isinstance(brands, DataFrame):
        listed = contained(flags, "s_key", "raw", brands, brands.columns[0], word_boundary).withColumn("_brand", F.lit(True))
        flags = flags.join(listed, "s_key", "left").withColumn("_brand", F.coalesce("_brand", F.lit(False)))
    else:
        flags = flags.withColumn("_brand", text.is_brand(F.col("raw"), brands, word_boundary))
    open_to_names = ~text.too_generic(F.col("normal")) & (~text.is_commercial(F.col("raw")) | (F.col("social_economy_name_candidate") == "YES") | F.col("_brand"))
    return flags.withColumn("by_name", open_to_names).drop("_brand")


def register(master: DataFrame, key: str, name: str = "entity_name", tax: str = "tax_id_root", listed: str = "ei_register_name", country: str = "country", region: str = "ccaa") -> DataFrame:
    return master.select(
        F.col(key).alias("m_key"), F.col(name).alias("m_name"), F.col(listed).alias("m_register"), F.upper(text.strip(F.col(country))).alias("m_land"), F.col(region).alias("m_region"),
        text.name_for_matching(F.col(name)).alias("m_normal"), ids.tax_key(F.col(tax)).alias("m_tax"), ids.siren(F.col(tax)).alias("m_siren"),
    )


def first_per(master: DataFrame, key: str) -> DataFrame:
    """The first row (least m_key) of each non-empty key; combines on the map side."""
    what = F.struct("m_name", "m_register", "m_land", "m_region")
    return master.where(F.coalesce(F.col(key), F.lit("")) != "").groupBy(key).agg(F.min_by(what, "m_key").alias("m"))


def grouped(suppliers: DataFrame, master: DataFrame, prefix: int = 8) -> tuple[DataFrame, DataFrame]:
    """(suppliers, master) with `group`: country and first letters of the normal name, or the letters alone for suppliers whose country is unknown.

    A register row stands in both of its groups.
    """
    left = suppliers.withColumn("group", F.concat_ws("|", F.when(F.col("land") == "", "*").otherwise(F.col("land")), text.block_key(F.col("normal"), prefix)))
    lands = F.explode(F.array(F.lit("*"), F.coalesce("m_land", F.lit(""))))
    right = master.where("m_normal <> ''").withColumn("_in", lands).withColumn("group", F.concat_ws("|", "_in", text.block_key(F.col("m_normal"), prefix))).drop("_in")
    return left, right


def fuzzy_best(suppliers: DataFrame, master: DataFrame, threshold: float = 92.0, prefix: int = 8) -> DataFrame:
    """s_key, raw, normal and the best register row of the supplier's block with its score, the least m_key among equals; none below the threshold.

    Distinct names of a block meet once, in blocks of bounded size; only the chosen names meet their rows again.
    """
    left, right = grouped(suppliers, master, prefix)
    best = nearest(left.select("group", "normal"), right.select("group", "m_normal", F.col("m_key").alias("first")), 1, threshold)
    chosen = best.select("group", "normal", F.col("first").alias("m_key"), "score").join(master, "m_key")
    return left.select("s_key", "raw", "normal", "group").join(chosen, ["group", "normal"]).drop("group")


def containing(texts: DataFrame, body: str, words: DataFrame, word: str, on: list[str] | None = None, q: int = 4) -> DataFrame:
    """The rows of `texts` joined with each word of `words` that `body` contains, and equal in the columns `on`.

    An inverted index: each word stands under its rarest run of q letters (shorter ones under themselves), texts
    are looked up with all of theirs, and what is found is verified. Null and empty words are in no text.
    """
    on = on or []
    runs = lambda c, n: F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(c) - n + 1)), lambda i: F.substring(c, i, n)))
    listed = words.select(*on, F.col(word).alias("_word")).where("_word <> ''").distinct()
    cut = listed.withColumn("_run", F.explode(runs(F.col("_word"), F.least(F.lit(q), F.length("_word")))))
    index = durable(shuffled(cut).join(shuffled(cut.groupBy(*on, "_run").agg(F.count("*").alias("_n"))), [*on, "_run"]).groupBy(*on, "_word").agg(F.min_by("_run", F.struct("_n", "_run")).alias("_run")))
    sizes = sorted(r[0] for r in index.select(F.length("_run")).distinct().collect())  # at most q numbers
    every = F.flatten(F.array(*[runs(F.col(body), F.lit(n)) for n in sizes])) if sizes else F.array().cast("array<string>")
    looked = texts.where(F.col(body).isNotNull()).withColumn("_run", F.explode(every))
    hit = shuffled(looked).join(shuffled(index), [*on, "_run"]).where(F.col(body).contains(F.col("_word")))
    return hit.select(*texts.columns, F.col("_word").alias(word)).distinct()


def contained(raw: DataFrame, key: str, name: str, brands: DataFrame, brand: str, word_boundary: bool = False) -> DataFrame:
    """`key` of the rows whose name contains one of the brands, whatever the case; with word_boundary as whole words. Null and blank brands are none."""
    listed = brands.select(F.lower(text.strip(F.col(brand))).alias("_brand"))
    hit = containing(raw.select(F.col(key).alias("_key"), F.lower(F.col(name)).alias("_name")), "_name", listed, "_brand")
    if word_boundary:
        whole = F.concat(F.lit("(?U)\\b\\Q"), F.replace("_brand", F.lit("\\E"), F.lit("")), F.lit("\\E\\b"))
        hit = hit.where(F.regexp_like("_name", whole))
    return hit.select(F.col("_key").alias(key)).distinct()


def vetoed(raw: Column, other: Column) -> Column:
    """A cooperative is no association and the other way round."""
    coop, assoc = (lambda x: text.contains_any(x, V.COOP_WORDS)), (lambda x: text.contains_any(x, V.ASSOC_WORDS))
    return (coop(raw) & assoc(other)) | (assoc(raw) & coop(other))


def match(suppliers: DataFrame, master: DataFrame, threshold: float = 92.0, prefix: int = 8) -> DataFrame:
    """One row per supplier of prepared(): its flags and OUTPUT. master: rows of register().

    Stages: equal tax number (score 100), SIREN (98), best fuzzy name of the block (at most 99). Later stages see
    only suppliers without a match; null and empty keys never match. A veto or too few shared tokens after the
    best candidate is chosen leave the supplier unmatched. Suppliers that occur twice are matched each.
    """
    suppliers, master = durable(suppliers), durable(master)  # normal names and flags are costly and used in every stage
    tax = small_side(first_per(master, "m_tax")).withColumnRenamed("m_tax", "tax_key").withColumnRenamed("m", "by_tax")
    siren = small_side(first_per(master, "m_siren")).withColumnRenamed("m_siren", "siren").withColumnRenamed("m", "by_siren")
    keyed = suppliers.join(tax, "tax_key", "left").join(siren, "siren", "left")
    left = keyed.where("by_tax IS NULL AND by_siren IS NULL AND by_name").select("s_key", "raw", "land", "normal")
    best = fuzzy_best(left, master, threshold, prefix)
    shared = F.size(F.array_intersect(text.meaningful_tokens(F.col("normal")), text.meaningful_tokens(F.col("m_normal"))))
    good = best.where(~vetoed(F.col("raw"), F.col("m_name")) & (shared >= 2)).select("s_key", F.struct("m_name", "m_register", "m_land", "m_region").alias("by_fuzzy"), F.least(F.lit(99), F.floor("score").cast("int")).alias("fuzzy"))
    out = keyed.join(good, "s_key", "left")
    hit = F.coalesce("by_tax", "by_siren", "by_fuzzy")
    kind = F.when(F.col("by_tax").isNotNull(), "tax_id_exact").when(F.col("by_siren").isNotNull(), "tax_id_siren_bridge").when(F.col("by_fuzzy").isNotNull(), "name_fuzzy")
    points = F.when(F.col("by_tax").isNotNull(), 100).when(F.col("by_siren").isNotNull(), 98).otherwise(F.col("fuzzy"))
    flags = ("name_coop_candidate", "name_marker_candidate", "name_candidate_reason", "name_candidate_trigger", "social_economy_name_candidate")
    return out.select(
        "s_key", F.col("raw").alias("_supplier_raw_name"), F.col("land").alias("supplier_country"), *flags,
        F.when(hit.isNotNull(), "YES").otherwise("NO").alias("social_enterprise_supplier"), hit.m_register.alias("matched_register"), hit.m_name.alias("matched_entity_name"),
        kind.alias("match_type"), points.cast("double").alias("match_score"), hit.m_land.alias("match_country"), hit.m_region.alias("match_region"),
    )
