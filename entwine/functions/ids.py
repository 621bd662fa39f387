"""Identifiers, web addresses and keys as native expressions, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from entwine.functions.text import quoted, strip, strip_sql


def found(x: Column, pattern: str, group: int = 1) -> Column:
    """The first match, null if there is none."""
    return F.nullif(F.regexp_extract(x, pattern, group), F.lit(""))


def found_sql(x: str, pattern: str, group: int = 1) -> str:
    return f"nullif(regexp_extract({x}, {quoted(pattern)}, {group}), '')"


def tax_key(x: Column) -> Column:
    """Upper case, letters and digits only; null gives ''."""
    return F.coalesce(F.regexp_replace(F.upper(x), "[^A-Z0-9]", ""), F.lit(""))


def tax_key_sql(x: str) -> str:
    return f"coalesce(regexp_replace(upper({x}), '[^A-Z0-9]', '', 'g'), '')"


def siren(x: Column) -> Column:
    """Nine digits, or the first nine of fourteen, whatever stands between them."""
    digits = F.regexp_replace(x, "[^0-9]", "")
    return F.when(F.length(digits) == 14, F.substring(digits, 1, 9)).when(F.length(digits) == 9, digits)


def siren_sql(x: str) -> str:
    d = f"regexp_replace({x}, '[^0-9]', '', 'g')"
    return f"CASE length({d}) WHEN 14 THEN substring({d}, 1, 9) WHEN 9 THEN {d} END"


def siren_of_digits(x: Column) -> Column:
    """The same for texts of digits only."""
    return found(strip(x), r"^(\d{9})(?:\d{5})?$")


def siren_of_digits_sql(x: str) -> str:
    return found_sql(strip_sql(x), r"^([0-9]{9})(?:[0-9]{5})?$")


def siren_of_sheet(x: Column) -> Column:
    """Nine digits of a spreadsheet cell, which may end in '.0'."""
    return found(F.regexp_replace(F.regexp_replace(strip(x), r"\.0$", ""), r"[^0-9]", ""), r"^(\d{9})$")


def siren_of_sheet_sql(x: str) -> str:
    return found_sql(f"regexp_replace(regexp_replace({strip_sql(x)}, '\\.0$', ''), '[^0-9]', '', 'g')", "^([0-9]{9})$")


ES_TAX = r"\b(\d{8}[A-Z]|[XYZ]\d{7}[A-Z]|[ABCDEFGHJNPQRSUVW]\d{7}[0-9A-J])\b"
ANY_TAX = r"\b([A-Z]\d{7}[A-Z0-9]|\d{8}[A-Z])\b"


def tax_es(x: Column) -> Column:
    """Spanish tax number after blanks, -, . and : are taken out; '' if there is none, null included."""
    return F.coalesce(F.regexp_extract(F.regexp_replace(F.upper(x), "[ .:-]", ""), ES_TAX, 1), F.lit(""))


def tax_es_sql(x: str) -> str:
    return f"coalesce(regexp_extract(regexp_replace(upper({x}), '[ .:-]', '', 'g'), {quoted(ES_TAX)}, 1), '')"


def tax_any(x: Column) -> Column:
    return found(F.upper(x), ANY_TAX)


def tax_any_sql(x: str) -> str:
    return found_sql(f"upper({x})", ANY_TAX)


def tax_fr(x: Column) -> Column:
    return F.coalesce(found(x, r"\b(\d{14})\b"), found(x, r"\b(\d{9})\b"))


def tax_fr_sql(x: str) -> str:
    return f"coalesce({found_sql(x, r'\b(\d{14})\b')}, {found_sql(x, r'\b(\d{9})\b')})"


def tax_it(x: Column) -> Column:
    up = F.upper(strip(x))
    return F.coalesce(found(up, r"\b(\d{11})\b"), found(up, r"\b([A-Z0-9]{16})\b"))


def tax_it_sql(x: str) -> str:
    up = f"upper({strip_sql(x)})"
    return f"coalesce({found_sql(up, r'\b(\d{11})\b')}, {found_sql(up, r'\b([A-Z0-9]{16})\b')})"


def tax_by_country(country: Column, x: Column) -> Column:
    """The extractor of the country, where it has one; else the text itself."""
    return F.when(F.upper(country) == "IT", tax_it(x)).when(F.upper(country) == "ES", tax_es(x)).otherwise(x)


def tax_root(country: Column, tax: Column) -> Column:
    """What links records: for FR the SIREN or null, elsewhere the number without outer blanks; blank and 'nan' give null."""
    text = strip(tax)
    known = F.when(~F.lower(text).isin("", "nan"), text)
    return F.when(F.upper(country) == "FR", siren(known)).otherwise(known)


def tax_root_sql(country: str, tax: str) -> str:
    known = f"(CASE WHEN lower({strip_sql(tax)}) NOT IN ('', 'nan') THEN {strip_sql(tax)} END)"
    return f"CASE WHEN upper({country}) = 'FR' THEN {siren_sql(known)} ELSE {known} END"


def entity_id(country: Column, root: Column, tax: Column, register: Column, number: Column, normal: Column) -> Column:
    """A stable id: by tax number, else by register and number, else by normal name."""
    number_of = F.coalesce(F.nullif(strip(root), F.lit("")), F.nullif(strip(tax), F.lit("")))
    land = F.upper(F.coalesce(country, F.lit("")))
    listed = (F.coalesce(register, F.lit("")) != "") & (F.coalesce(number, F.lit("")) != "")
    return F.md5(F.when(number_of.isNotNull(), F.concat_ws("|", land, F.lit("TAX"), number_of)).when(listed, F.concat_ws("|", land, F.lit("REG"), register, number)).otherwise(F.concat_ws("|", land, F.lit("NAME"), F.coalesce(normal, F.lit("")))))


def entity_id_sql(country: str, root: str, tax: str, register: str, number: str, normal: str) -> str:
    n = f"coalesce(nullif({strip_sql(root)}, ''), nullif({strip_sql(tax)}, ''))"
    land = f"upper(coalesce({country}, ''))"
    return f"md5(CASE WHEN {n} IS NOT NULL THEN concat_ws('|', {land}, 'TAX', {n}) WHEN coalesce({register}, '') <> '' AND coalesce({number}, '') <> '' THEN concat_ws('|', {land}, 'REG', {register}, {number}) ELSE concat_ws('|', {land}, 'NAME', coalesce({normal}, '')) END)"


def domain(url: Column, legacy_strip: bool = False) -> Column:
    """Host of an address in lower case, without user, port and www; '' for null. legacy_strip drops any leading w and dots."""
    text = F.lower(strip(F.coalesce(url, F.lit(""))))
    host = F.regexp_replace(F.regexp_replace(F.regexp_extract(text, r"^(?:[a-z][a-z0-9+.-]*://)?([^/?#]*)", 1), "^.*@", ""), ":.*$", "")
    return F.regexp_replace(host, r"^[w.]+" if legacy_strip else r"^www\.", "")


def domain_sql(url: str, legacy_strip: bool = False) -> str:
    text = f"lower({strip_sql(f"coalesce({url}, '')")})"
    host = f"regexp_replace(regexp_replace(regexp_extract({text}, '^(?:[a-z][a-z0-9+.-]*://)?([^/?#]*)', 1), '^.*@', ''), ':.*$', '')"
    return f"regexp_replace({host}, '{'^[w.]+' if legacy_strip else r'^www\.'}', '')"


def absolute(base: Column, href: Column) -> Column:
    """A link as a full address, for links that are full, or start with / or not."""
    root = F.regexp_extract(base, r"^([a-z]+://[^/]+)", 1)
    return F.when(href.rlike(r"^[a-z]+://"), href).when(href.startswith("/"), F.concat(root, href)).otherwise(F.concat(F.regexp_replace(base, r"[^/]*$", ""), href))


def filled(*columns: Column) -> Column:
    """How many of the values are neither null nor blank."""
    return sum((F.when(F.coalesce(strip(c), F.lit("")) != "", 1).otherwise(0) for c in columns), F.lit(0))


def filled_sql(*columns: str) -> str:
    return "(" + " + ".join(f"CASE WHEN coalesce({strip_sql(c)}, '') <> '' THEN 1 ELSE 0 END" for c in columns) + ")"
