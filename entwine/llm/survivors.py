"""The best representative of each group of duplicates, field by field (problem 1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entwine.plans.durable import small_side

#: Entries that say nothing, folded to lower case and single blanks, without signs at the end.
PLACEHOLDERS = """
n/a|na|n.a|n. a|none|null|nil|nan|tbd|tbc|tba|unknown|not available|not applicable|no data|see website|description to follow|to follow
to be confirmed|to be completed|coming soon|lorem ipsum|xxx|xx|x|test|todo|pendiente|por definir|sin datos|s/d|s. d|sd|no disponible|desconocido
à compléter|a compléter|a completer|non disponible|inconnu|néant|k. a|k.a|keine angabe|keine angaben|unbekannt|folgt|nicht verfügbar
da completare|non disponibile|sconosciuto|n. d|n.d|n/d|nd|brak|brak danych|b/d|onbekend|n.v.t|nvt|volgt|a preencher|desconhecido|não disponível|s/i
""".strip().replace("\n", "|").split("|")

HOST = r"(?iU)^\s*(?:[a-z][a-z0-9+.-]*://)?(?:[^/@\s]*@)?(?:[\p{L}\p{N}-]+\.)+[\p{L}\p{N}-]+(?::\d*)?(?:[/?#]\S*)?\s*$"
ENDS = r"(?U)(?<![.…])[.!?][\"'”»)\]]*\s*$"
BROKEN = r"(?iU)(?:…|\.\.|[\[(](?:…|\.+|more|mehr|más|suite|continua|sic)[\])])[\"'”»)\].]*\s*$"


def tells(value: Column) -> Column:
    """Not null, not blank, not a placeholder, and with a letter or digit."""
    folded = F.lower(F.regexp_replace(F.regexp_replace(value, r"(?U)^\s+|[\s.:;!]+$", ""), r"(?U)\s+", " "))
    return F.coalesce(value.rlike(r"(?U)[\p{L}\p{N}]") & ~folded.isin(PLACEHOLDERS), F.lit(False))


def has_host(value: Column) -> Column:
    return tells(value) & F.coalesce(value.rlike(HOST), F.lit(False))


def is_whole(value: Column) -> Column:
    """A text that does not break off: it ends as a sentence ends, and not with an ellipsis."""
    return tells(value) & F.coalesce(value.rlike(ENDS) & ~value.rlike(BROKEN), F.lit(False))


def source_key(source: Column) -> Column:
    """Sources however they are written: upper case, one underscore between words."""
    return F.regexp_replace(F.upper(F.regexp_replace(source, r"(?U)^[\s_-]+|[\s_-]+$", "")), r"(?U)[\s_-]+", "_")


def survivors(rows: DataFrame, group: str, key: str, source: str, time: str, fields: dict[str, Column], trust: DataFrame) -> DataFrame:
    """One row per group of two or more rows and field with a usable value.

    Columns: group_row_id (least key of the group), field_name, row_id (whose value survives), value.
    fields: for each field whether its value is usable. trust: source, trust_rank; sources that it does not
    name, null among them, are trusted least. Among equally trusted rows the latest `time` wins (null is
    earliest), then the least key. One aggregation over all groups; its maxima combine on the map side, so
    a group with a third of all rows is one partial row per task.
    """
    ranks = small_side(trust.select(source_key(F.col("source")).alias("_source"), F.col("trust_rank").alias("_rank")).groupBy("_source").agg(F.min("_rank").alias("_rank")))
    ranked = rows.withColumn("_source", source_key(F.col(source))).join(ranks, "_source", "left")
    best = lambda name, usable: F.max(F.struct(usable.alias("usable"), (-F.coalesce("_rank", F.lit(2**31 - 1))).alias("trust"), F.col(time).alias("time"), (-F.col(key)).alias("order"), F.col(name).alias("value"))).alias(name)
    found = ranked.groupBy(group).agg(F.count("*").alias("_n"), F.min(key).alias("group_row_id"), *[best(n, u) for n, u in fields.items()]).where("_n > 1")
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("field_name"), F.col(f"{n}.usable").alias("usable"), (-F.col(f"{n}.order")).alias("row_id"), F.col(f"{n}.value").alias("value")) for n in fields]))
    return found.select("group_row_id", each.alias("e")).select("group_row_id", "e.*").where("usable").drop("usable")
