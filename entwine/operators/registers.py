"""Sources of any shape mapped to the canonical register table."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entwine.functions import ids, text
from entwine.functions.values import CANONICAL

NAME_HINTS = ("entity_name", "name", "nombre", "denominacion", "denominación", "razon social", "razón social", "entidad", "empresa", "organisation", "organization", "denominationunitelegale")
TAX_HINTS = ("cif", "nif", "tax", "siren", "siret", "partita iva", "codice fiscale", "vat")
REPORT = "run_date string, source_index int, country string, ccaa string, source_type string, ei_register_name string, source_url string, status string, rows_extracted long, error string"
META = ("country", "ccaa", "ei_register_name", "source_url", "source_type", "retrieved_at")


def header(name: str) -> str:
    return re.sub(r"\s+", " ", name).strip().lower()


def clean_headers(df: DataFrame) -> DataFrame:
    """Headers in lower case with single blanks; of equal ones the later get a number."""
    seen: dict[str, int] = {}
    out = []
    for c in map(header, df.columns):
        seen[c] = seen.get(c, 0) + 1
        out.append(c if seen[c] == 1 else f"{c}_{seen[c]}")
    return df.toDF(*out)


def find_column(df: DataFrame, candidates: tuple[str, ...] | list[str], required: bool = False) -> str | None:
    """The first candidate that is a column, whatever the case."""
    there = {header(c): c for c in reversed(df.columns)}
    found = next((there[header(c)] for c in candidates if header(c) in there), None)
    if required and found is None:
        raise ValueError(f"none of {list(candidates)} among {df.columns}")
    return found


def require(df: DataFrame, columns: list[str]) -> None:
    missing = [c for c in columns if find_column(df, [c]) is None]
    if missing:
        raise ValueError(f"missing columns {missing} among {df.columns}")


def apply_mapping(df: DataFrame, mapping: dict[str, list[str]]) -> DataFrame:
    """Each target from its first candidate that exists; others and unmapped columns fall away. No mapping changes nothing."""
    if not mapping:
        return df
    picks = [(t, find_column(df, c)) for t, c in mapping.items()]
    return df.select(*[F.col(f"`{c}`").alias(t) for t, c in picks if c])


def default_mapping(df: DataFrame) -> DataFrame:
    """For sources without a mapping: a column that looks like names, and a tax number from its column or out of the name."""
    name = find_column(df, NAME_HINTS) or next((c for c in df.columns if any(h in header(c) for h in ("name", "nombre", "denomin", "entidad"))), df.columns[0])
    tax = next((c for c in df.columns if any(h in header(c) for h in TAX_HINTS)), None)
    number = F.coalesce(F.nullif(text.strip(F.col(f"`{tax}`").cast("string")), F.lit("")), ids.tax_any(F.col(f"`{name}`"))) if tax else ids.tax_any(F.col(f"`{name}`"))
    return df.select(F.col(f"`{name}`").cast("string").alias("entity_name"), number.alias("tax_id"))


def siren_rows(df: DataFrame, name: str, siren: str) -> DataFrame:
    """country, entity_name, tax_id, tax_id_root of French sheet rows that have a name and a SIREN of nine digits."""
    number = ids.siren_of_sheet(F.col(siren))
    rows = df.select(F.lit("FR").alias("country"), text.clean_text(F.col(name)).alias("entity_name"), number.alias("tax_id"), number.alias("tax_id_root"))
    return rows.where("entity_name IS NOT NULL AND tax_id IS NOT NULL")


def filled_in(df: DataFrame, meta: dict[str, str | None]) -> DataFrame:
    """Literals for columns that are missing or hold nothing at all; one aggregation looks at all of them."""
    there = [c for c in meta if c in df.columns]
    empty = set(meta) - set(there)
    if there:
        counts = df.agg(*[F.count(c).alias(c) for c in there]).first()
        empty |= {c for c in there if not counts[c]}
    return df.withColumns({c: F.lit(meta[c]).cast("string") for c in meta if c in empty})


def canonical(df: DataFrame) -> DataFrame:
    """The canonical columns: normal name, tax number by the country's extractor, legal form and root; what is missing is null."""
    known = df.select(*[(F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")).alias(c) for c in CANONICAL])
    form = F.coalesce("legal_form_local", text.legal_form(F.col("entity_name")))
    out = known.withColumns({"entity_name": text.clean_text(F.col("entity_name")), "tax_id": ids.tax_by_country(F.col("country"), F.col("tax_id")), "legal_form_local": form, "base_legal_form_family": F.coalesce("base_legal_form_family", text.form_family(form))})
    return out.withColumns({"entity_name_norm": text.name_for_register(F.col("entity_name")), "tax_id_root": ids.tax_root(F.col("country"), F.col("tax_id"))}).select(*CANONICAL)


def run(spark: SparkSession, catalogue: list[dict], readers: dict[str, Callable[[SparkSession, dict], DataFrame]], run_date: str) -> tuple[DataFrame, DataFrame]:
    """(canonical table, report) of the enabled sources of a catalogue.

    readers: by the source's parser or type. A source that fails gives a report row with the error and no rows;
    the number of rows is counted per source, as data errors show only then. Source entries: country, ccaa, type,
    url, name or ei_register_name or register_name, enabled, mapping, parser.
    """
    parts, report = [], []
    for i, source in enumerate((s for s in catalogue if s.get("enabled", True)), 1):
        name = source.get("ei_register_name") or source.get("register_name") or source.get("name")
        line = [run_date, i, source.get("country"), source.get("ccaa"), source.get("type"), name, source.get("url")]
        try:
            raw = readers[source.get("parser") or source["type"]](spark, source)
            ready = set(raw.columns) <= set(CANONICAL) and "entity_name" in raw.columns
            shaped = raw if ready else apply_mapping(clean_headers(raw), source["mapping"]) if source.get("mapping") else default_mapping(raw)
            part = canonical(filled_in(shaped, dict(zip(META, (source.get("country"), source.get("ccaa"), name, source.get("url"), source.get("type"), run_date)))))
            rows = part.count()
            parts.append(part)
            report.append((*line, "OK", rows, None))
        except Exception as error:  # noqa: BLE001
            report.append((*line, "ERROR", 0, str(error).splitlines()[0][:500] if str(error) else type(error).__name__))
    table = spark.createDataFrame([], ", ".join(f"{c} string" for c in CANONICAL))
    for part in parts:
        table = table.unionByName(part)
    return table, spark.createDataFrame(report, REPORT)


ESS = ("siren", "denominationUniteLegale", "denominationUsuelle1UniteLegale", "categorieJuridiqueUniteLegale", "economieSocialeSolidaireUniteLegale", "nicSiegeUniteLegale", "codePostalSiegeUniteLegale", "libelleCommuneSiegeUniteLegale")


def social_economy_units(units: DataFrame, flag: str = "economieSocialeSolidaireUniteLegale", wanted: tuple[str, ...] = ESS) -> DataFrame:
    """Units flagged 'O', with those of the wanted columns that exist; the filter and the columns reach the scan."""
    require(units, [flag])
    return units.where(F.upper(F.col(flag)) == "O").select(*[c for c in wanted if c in units.columns])
