"""The queries of the problems tagged llm, over the tables of one folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entwine.llm import copies, encoding, leaks, linkage, mixing, names, personal, survivors, variants
from entwine.sources.tables import table


def both_names(spark: SparkSession, folder: str) -> DataFrame:
    """table_name, row_id, name, land of registers and trusted entities."""
    registers = table(spark, folder, "ei_registers_normalized").select(F.lit("ei_registers_normalized").alias("table_name"), "row_id", F.col("entity_name").alias("name"), F.upper("country").alias("land"))
    trusted = table(spark, folder, "trusted_entities").select(F.lit("trusted_entities").alias("table_name"), "row_id", F.col("raw_brand_name").alias("name"), names.land_of(F.col("country_hint")).alias("land"))
    return registers.unionByName(trusted)


def mended(rows: DataFrame) -> DataFrame:
    """`rows` (table_name, row_id, name, land) with garbled names restored as far as they can be."""
    fixed = encoding.restore(rows, rows).select("row_id", F.col("restored").alias("mended")).distinct()
    return rows.join(fixed, "row_id", "left").select("table_name", "row_id", F.coalesce("mended", "name").alias("name"), "land")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """The rows whose summary, website and sector survive for each organisation in trusted_entities."""
    trusted = table(spark, folder, "trusted_entities")
    named = mended(both_names(spark, folder)).where("table_name = 'trusted_entities'").select("row_id", "name", "land")
    grouped = variants.entities(named, cities(spark, folder))
    fields = {"business_summary": survivors.is_whole(F.col("business_summary")), "website_hint": survivors.has_host(F.col("website_hint")), "sector": survivors.tells(F.col("sector"))}
    found = survivors.survivors(trusted.join(grouped, "row_id"), "entity", "row_id", "source", "updated_at", fields, table(spark, folder, "roster_sources"))
    return found.select("group_row_id", "field_name", "row_id")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Garbled names and what they were; the empty string where characters are lost for good."""
    rows = both_names(spark, folder)
    return encoding.restore(rows, rows).select("table_name", "row_id", F.when(F.col("lost"), "").otherwise(F.col("restored")).alias("restored"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Register records and trusted names with copies that differ in formatting only."""
    registers = table(spark, folder, "ei_registers_normalized").where(~encoding.suspect(F.col("entity_name"), F.col("country")))
    trusted = table(spark, folder, "trusted_entities").where(~encoding.suspect(F.col("raw_brand_name"), names.land_of(F.col("country_hint"))))
    found = [
        copies.count_copies(registers, "row_id", "entity_name", "country", "postcode", "city").select(F.lit("ei_registers_normalized").alias("table_name"), "*"),
        copies.count_copies(trusted, "row_id", "raw_brand_name").select(F.lit("trusted_entities").alias("table_name"), "*"),
    ]
    return found[0].unionByName(found[1])


def supplier_names(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "suppliers", "row_id", "_supplier_raw_name", "supplier_country")
    name = F.col("_supplier_raw_name")
    leaked = F.lower(F.regexp_replace(name, r"(?U)^\s+|\s+$", "")) == "column2"
    return rows.where(F.when(F.contains(name, F.lit("2")), ~leaked).otherwise(name.isNotNull())).select(F.lit("suppliers").alias("table_name"), "row_id", F.col("_supplier_raw_name").alias("name"), names.land_of(F.col("supplier_country")).alias("land"))


def cities(spark: SparkSession, folder: str) -> frozenset[str]:
    return names.gazetteer(table(spark, folder, "ei_registers_normalized", "city"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of rows whose names are spellings of one name."""
    rows = both_names(spark, folder).unionByName(supplier_names(spark, folder)).drop("table_name")
    clean = rows.where(~encoding.suspect(F.col("name"), F.col("land"))).withColumn("hashes", copies.name_hashes(F.col("name")))
    words, whole, single = (F.col(f"hashes.{h}").alias(h) for h in copies.KEYS)
    # most names have no letters alone, so what leaves them alone is the first hash again and need not be carried along
    linked = variants.entities(clean.select("row_id", words, whole, F.when(words != single, single).alias("single"), "name", "land"), cities(spark, folder))
    return variants.variant_pairs(linked.withColumn("single", F.coalesce("single", "words")))


def p7_matches(spark: SparkSession, folder: str) -> DataFrame:
    """Register and trusted rows of one organisation, with a confidence."""
    named = mended(both_names(spark, folder))
    registers = table(spark, folder, "ei_registers_normalized", "row_id", "tax_id", "tax_id_root", "se_recognition_evidence").select(
        "row_id", linkage.host(F.col("se_recognition_evidence")).alias("web"), F.coalesce(linkage.tax_number(F.col("tax_id_root")), linkage.tax_number(F.col("tax_id"))).alias("tax")
    )
    in_text = F.regexp_extract("business_summary", r"(?U)\(([A-Z]{0,2}[\w .-]*\d[\w .-]*)\)\W*$", 1)
    trusted = table(spark, folder, "trusted_entities", "row_id", "website_hint", "business_summary").select(
        "row_id", linkage.host(F.trim("website_hint")).alias("web"), linkage.tax_number(in_text).alias("tax")
    )
    sides = [named.where(F.col("table_name") == t).drop("table_name").join(x, "row_id") for t, x in (("ei_registers_normalized", registers), ("trusted_entities", trusted))]
    return linkage.matches(*sides, cities(spark, folder))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return p7_matches(spark, folder).where(F.col("confidence") >= linkage.MATCH).select("row_id_a", "row_id_b")


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents and the evaluation items that leaked into them."""
    return leaks.leaks(table(spark, folder, "documents", "doc_id", "text"), table(spark, folder, "eval_items", "item_id", "text")).select("doc_id", "item_id")


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in documents, each distinct value as it stands."""
    return personal.scan(table(spark, folder, "documents", "doc_id", "text"))[0]


def p10_masked(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with typed placeholders in place of personal data."""
    return personal.scan(table(spark, folder, "documents", "doc_id", "text"))[1]


def p9_shares(spark: SparkSession, folder: str) -> DataFrame:
    """The share of tokens that each source reaches."""
    return mixing.mix(table(spark, folder, "documents", "doc_id", "source", "text"), table(spark, folder, "mix_targets"))[1]


def p9_selection(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of the mixture and how often each is used."""
    return mixing.mix(table(spark, folder, "documents", "doc_id", "source", "text"), table(spark, folder, "mix_targets"))[0]


QUERIES = {"p9_shares": p9_shares, "p9_selection": p9_selection, "p10_found": p10_found, "p10_masked": p10_masked, "p8_found": p8_found, "p7_found": p7_found, "p7_matches": p7_matches, "p1_found": p1_found, "p4_found": p4_found, "p3_found": p3_found, "p5_found": p5_found}

#: SQL for the queries that it can express; the others are tested against brute force.
SQL: dict[str, str] = {}
