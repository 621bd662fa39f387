"""Arriving suppliers matched with a register that does not change: a stream joined with a table, without state.

Beyond the batch operators; tax number and SIREN only, as the best fuzzy candidate needs a whole block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entwine.operators import matching
from entwine.plans.durable import small_side


def match_arriving(suppliers: DataFrame, master: DataFrame) -> DataFrame:
    """suppliers: a stream of matching.prepared() rows; master: rows of matching.register()."""
    tax = small_side(matching.first_per(master, "m_tax")).withColumnRenamed("m_tax", "tax_key").withColumnRenamed("m", "by_tax")
    siren = small_side(matching.first_per(master, "m_siren")).withColumnRenamed("m_siren", "siren").withColumnRenamed("m", "by_siren")
    keyed = suppliers.join(tax, "tax_key", "left").join(siren, "siren", "left")
    hit = F.coalesce("by_tax", "by_siren")
    kind = F.when(F.col("by_tax").isNotNull(), "tax_id_exact").when(F.col("by_siren").isNotNull(), "tax_id_siren_bridge")
    return keyed.select("s_key", "raw", hit.m_name.alias("matched_entity_name"), kind.alias("match_type"))
