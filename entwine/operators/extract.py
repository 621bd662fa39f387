"""Records out of lines, pages and tables of text.

Lines carry their place; whatever depends on lines before is a running flag or the last value so far over the
lines of one document, so documents spread freely. Inputs of lines: doc, pos, line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entwine.functions import ids, text

#: Fixed values of the ranked listing.
REGIONS = "PA[IÍ]S VASCO|ANDALUC[IÍ]A|MURCIA|COMUNIDAD VALENCIANA|VALENCIANA|CATALU[NÑ]A|ARAG[OÓ]N|GALICIA|MADRID|CASTILLA.*|EXTREMADURA|NAVARRA|LA RIOJA|CANTABRIA|ASTURIAS|BALEARES|CANARIAS|CEUTA|MELILLA"
SIZES = "GRAN EMPRESA|MEDIANA EMPRESA|PEQUE[NÑ]A EMPRESA"
SECTORS = ("MULTISECTORIAL", "SERVICIOS", "PESCA", "AGROALIMENTARIO", "INDUSTRIA", "FINANZAS", "ENERGIA", "SALUD", "EDUCACION", "CONSTRUCCION", "VIVIENDA", "TRANSPORTE", "COMERCIO")
NOISE = ("COOPERATIVAS", "SOCIEDADES LABORALES", "COMUNIDAD", "REGIÓN DE", "REGION DE", "AGRICULTURA Y", "(MILLONES €) EMPRESA", "FACTURACIÓN TAMAÑO", "FACTURACION TAMAÑO")
AT_STATES = ("Wien", "Niederösterreich", "Oberösterreich", "Steiermark", "Salzburg", "Tirol", "Vorarlberg", "Kärnten", "Burgenland")

SOFAR = lambda *keys: Window.partitionBy("doc").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def collapse(x: Column) -> Column:
    return text.strip(F.regexp_replace(F.replace(x, F.lit(" "), F.lit(" ")), r"(?U)\s+", " "))


def bare(html: Column) -> Column:
    """HTML without tags; those inside a line leave no blank, others do."""
    inline = F.regexp_replace(html, r"(?i)</?(?:a|b|em|font|i|small|span|strong|sub|sup|u)\b[^>]*>", "")
    return collapse(F.regexp_replace(inline, "<[^>]*>", " "))


def lines(pages: DataFrame, doc: str, body: str) -> DataFrame:
    """doc, pos, line: the lines of each text, without blanks at the ends and empty ones."""
    each = pages.select(F.col(doc).alias("doc"), F.posexplode(F.split(body, "\r?\n")).alias("pos", "line"))
    return each.withColumn("line", collapse(F.col("line"))).where("line <> ''")


def numeric_tail_cut(x: Column) -> Column:
    """Cut before the first number with thousands points, then before the first number at all."""
    first = F.split(collapse(x), r"\s+\d{1,3}(?:\.\d{3})+(?:,\d+)?(?:\s*€)?", 2)[0]
    return collapse(F.split(text.strip(first), r"\s+\d+(?:[.,]\d+)?(?:\s*€)?", 2)[0])


def row_tail(tail: Column) -> Column:
    """struct(entity_name, region, sector) of a ranked line without its rank."""
    line = collapse(F.regexp_replace(collapse(tail), f"(?iu)(?:{SIZES})$", ""))
    region = F.upper(F.regexp_extract(line, f"(?iu)({REGIONS})$", 1))
    named = numeric_tail_cut(F.regexp_replace(line, f"(?iu)(?:{REGIONS})$", ""))
    sector = F.upper(F.regexp_extract(named, r"(?iu)(?<!\w)(" + "|".join(SECTORS) + ")$", 1))
    name = collapse(F.regexp_replace(named, r"(?iu)(?<!\w)(?:" + "|".join(SECTORS) + ")$", ""))
    return F.struct(name.alias("entity_name"), F.when(region == "VALENCIANA", "COMUNIDAD VALENCIANA").otherwise(region).alias("region"), sector.alias("sector"))


def is_noise(line: Column) -> Column:
    up = F.upper(line)
    return up.isin(*NOISE) | up.startswith("Nº NOMBRE") | up.startswith("N° NOMBRE")


def ranked_rows(numbered: DataFrame) -> DataFrame:
    """doc, rank_pos, place (pos of the first line), entity_name, region, sector: a row per line that starts with a rank, continued by the lines up to the next.

    A line that says only the region fills an empty region; others go on with the name. Names under three
    characters fall away; lines before the first rank do, too.
    """
    kept = numbered.where(~is_noise(F.col("line")))
    start = F.col("line").rlike(r"^\d+\s+")
    island = kept.withColumn("start", start).withColumn("rank_pos", F.sum(F.col("start").cast("int")).over(SOFAR())).where("rank_pos > 0")
    tail = F.regexp_replace("line", r"^\d+\s+", "")
    rows = island.groupBy("doc", "rank_pos").agg(
        F.max(F.when(F.col("start"), row_tail(tail))).alias("head"), F.max(F.when(F.col("start"), F.col("pos"))).alias("place"), F.array_sort(F.collect_list(F.when(~F.col("start"), F.struct("pos", "line")))).alias("more")
    )
    lone = lambda s: F.upper(s.line).isin("VALENCIANA", "COMUNIDAD VALENCIANA")
    empty = F.col("head.region") == ""
    rest = F.when(empty, F.filter("more", lambda s, i: ~lone(s) | F.exists(F.slice("more", 1, i), lone))).otherwise(F.col("more"))
    region = F.when(empty & F.exists("more", lone), "COMUNIDAD VALENCIANA").otherwise(F.col("head.region"))
    name = collapse(F.concat_ws(" ", "head.entity_name", F.array_join(F.transform(rest, lambda s: s.line), " ")))
    name = text.strip(F.regexp_replace(numeric_tail_cut(name), r"(?iu)\b(?:COMUNIDAD|REGI[ÓO]N DE|AGRICULTURA Y)$", ""))
    late = F.upper(F.regexp_extract(name, r"(?iu)\s(" + "|".join(SECTORS) + ")$", 1))
    out = rows.select("doc", "rank_pos", "place", name.alias("name"), region.alias("region"), F.col("head.sector").alias("sector"), late.alias("late"))
    last = F.when(F.col("sector") == "", F.regexp_replace("name", r"(?iu)\s+(?:" + "|".join(SECTORS) + ")$", "")).otherwise(F.col("name"))
    return out.select("doc", "rank_pos", "place", last.alias("entity_name"), "region", F.when(F.col("sector") == "", F.col("late")).otherwise(F.col("sector")).alias("sector")).where(F.length("entity_name") >= 3)


def address_records(numbered: DataFrame, postcode: str, name_ok: Column, headings: tuple[str, ...] = ()) -> DataFrame:
    """doc, pos, entity_name, address, postcode, city, region, website, email: name, street and a line that starts or ends with postcode and town.

    The town's line closes a record; a web or mail line belongs to the record before it; a heading holds until
    the next one. A record without name or street is none. The first of equal name, postcode and town stays.
    """
    low = F.lower("line")
    web, mail = F.col("line").startswith("http") | F.col("line").contains("www."), F.col("line").contains("@") & ~F.col("line").contains(" ")
    town = F.col("line").rlike(rf"(?:^|\s){postcode}\s+\D+$")
    head = F.col("line").isin(*headings) if headings else F.lit(False)
    phone = F.col("line").rlike(r"^\+?\d[\d\s()/.-]{6,}$") | low.rlike("^(?:fax|tel|telefon|phone)")
    kind = F.when(head, "head").when(web, "web").when(mail, "mail").when(town & ~phone, "town").when(phone, "phone").when(F.col("line").rlike(r"\d"), "street").when(name_ok & (F.length("line") >= 3), "name").otherwise("none")
    typed = numbered.withColumn("kind", kind).withColumn("closed", F.sum(F.when(F.col("kind") == "town", 1).otherwise(0)).over(SOFAR()))
    typed = typed.withColumn("closed", F.when(F.col("kind").isin("town", "web", "mail"), F.col("closed") - 1).otherwise(F.col("closed"))).withColumn("region", F.last(F.when(F.col("kind") == "head", F.col("line")), ignorenulls=True).over(SOFAR()))
    pick = lambda k, how: how(F.when(F.col("kind") == k, F.col("line")), "pos")
    of = lambda k: F.max_by("line", F.when(F.col("kind") == k, F.col("pos")))
    own = F.when(F.col("kind").isin("name", "street", "town"), F.col("pos"))
    rows = typed.where("closed >= 0").groupBy("doc", "closed").agg(F.max(own).alias("pos"), of("name").alias("entity_name"), of("street").alias("street"), of("town").alias("town"), of("web").alias("website"), of("mail").alias("email"), F.max_by("region", "pos").alias("region"))
    rows = rows.where("town IS NOT NULL AND entity_name IS NOT NULL")
    prefix = text.strip(F.regexp_replace(F.regexp_extract("town", rf"^(.*?)\s*{postcode}\s", 1), r"[\s–-]+$", ""))
    street = F.when(prefix.rlike(r"\d"), prefix).otherwise(F.regexp_replace("street", r"[\s–-]+$", ""))
    cut = rows.select("doc", "pos", "entity_name", street.alias("address"), F.regexp_extract("town", rf"({postcode})\s+\D+$", 1).alias("postcode"), F.regexp_extract("town", rf"{postcode}\s+(\D+)$", 1).alias("city"), "region", "website", "email").where("address IS NOT NULL")
    same = Window.partitionBy("doc", "entity_name", "postcode", "city").orderBy("pos")
    return cut.withColumn("_n", F.row_number().over(same)).where("_n = 1").drop("_n")


def german_workshops(numbered: DataFrame) -> DataFrame:
    return address_records(numbered, r"\d{5}", F.upper("line") != F.col("line"))


def austrian_workshops(numbered: DataFrame) -> DataFrame:
    """The same with states as headings and a legal form in every name."""
    form = F.col("line").rlike(r"(?i)\b(?:gGmbH|GmbH|Ges\.?\s*m\.?\s*b\.?\s*H|KG)\b|wien\s*work|teamwork") & ~F.col("line").rlike(r"[?:]$")
    hours = F.lower("line").rlike(r"^(?:mo|di|mi|do|fr|sa|so)[- ]|uhr")
    return address_records(numbered.where(~hours), r"\d{4}", form, AT_STATES)


def anchors(pages: DataFrame, doc: str, html: str, base: str | None = None) -> DataFrame:
    """doc, pos, label, href: the links of each page in order."""
    pattern = F.lit(r"""(?is)<a\b[^>]*?href\s*=\s*["']([^"']*)["'][^>]*>(.*?)</a>""")
    pairs = F.arrays_zip(F.regexp_extract_all(html, pattern, F.lit(1)).alias("href"), F.regexp_extract_all(html, pattern, F.lit(2)).alias("label"))
    each = pages.select(F.col(doc).alias("doc"), *([F.col(base).alias("_base")] if base else []), F.posexplode(pairs).alias("pos", "a"))
    label = bare(F.col("a.label"))
    href = text.strip(F.col("a.href"))
    return each.select("doc", "pos", label.alias("label"), (ids.absolute(F.col("_base"), href) if base else href).alias("href"))


def pdf_links(pages: DataFrame, doc: str, html: str, base: str | None = None) -> DataFrame:
    """The distinct links to PDF files, in order."""
    found = anchors(pages, doc, html, base).where(F.lower("href").rlike(r"\.pdf(?:[?#].*)?$"))
    return found.groupBy("doc", "href").agg(F.min("pos").alias("pos"))


def verified_links(pages: DataFrame, doc: str, html: str, base: str) -> DataFrame:
    """doc, entity_name, website: links with a name for a label, without boilerplate, mail, phone and photo credits; for pages with
    fewer than five, also lines in mixed case."""
    low = F.lower("label")
    linked = anchors(pages, doc, html).join(pages.select(F.col(doc).alias("doc"), F.col(base).alias("_url")), "doc")
    good = (F.length("label") >= 3) & ~low.rlike(r"^(?:mehr|read|learn|kontakt|impressum|datenschutz)") & ~low.rlike(r"\(c\)|©") & ~F.lower("href").rlike(r"^(?:#|mailto:|tel:)")
    site = F.when(F.col("href").startswith("/"), F.concat(F.regexp_replace("_url", "/+$", ""), "href")).otherwise(F.col("href"))
    named = linked.where(good).groupBy("doc", F.col("label").alias("entity_name"), F.when(site.startswith("http") | site.contains("www."), site).alias("website")).agg(F.min("pos").alias("pos"))
    few = pages.select(F.col(doc).alias("doc")).join(named.groupBy("doc").agg(F.count("*").alias("n")).where("n >= 5"), "doc", "left_anti")
    plain = pages.select(F.col(doc).alias("doc"), F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style).*?</\1>", ""), "<[^>]*>", "\n").alias("body")).join(few, "doc")
    said = F.regexp_replace("line", r"(?i)\s*(?:\(c\)|©).*$", "")
    mixed = lines(plain, "doc", "body").withColumn("line", text.strip(said)).where(F.length("line").between(3, 80) & F.col("line").rlike(r"^\p{L}") & F.col("line").rlike(r"\p{Ll}") & F.col("line").rlike(r"\p{Lu}") & ~F.lower("line").rlike("^(?:erfahre|verified|social|enterprise)"))
    more = mixed.join(named.select("doc", F.col("entity_name").alias("line")).distinct(), ["doc", "line"], "left_anti").groupBy("doc", F.col("line").alias("entity_name")).agg(F.min("pos").alias("pos")).withColumn("website", F.lit(None).cast("string"))
    return named.unionByName(more).withColumn("se_recognition_type", F.lit("Label")).withColumn("se_recognition_name", F.lit("Verified Social Enterprise (SENA)"))


def html_rows(pages: DataFrame, doc: str, html: str) -> DataFrame:
    """doc, pos, cells: the rows of all tables of a page; header cells count as cells."""
    rows = F.regexp_extract_all(html, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1))
    each = pages.select(F.col(doc).alias("doc"), F.posexplode(rows).alias("pos", "row"))
    cells = F.transform(F.regexp_extract_all("row", F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]>"), F.lit(1)), bare)
    return each.select("doc", "pos", cells.alias("cells")).where(F.size("cells") > 0)


def table_records(rows: DataFrame) -> DataFrame:
    """doc, pos, ei_registration_number, tax_id, entity_name, legal_form_local of rows of cells: the code, the first tax number,
    and the longest other cell, the first of several. Rows with at most one filled cell, or with nothing found, fall away."""
    tidy = F.transform("cells", lambda c: collapse(F.regexp_replace(c, "[•▪·]", " ")))
    full = rows.select("doc", "pos", tidy.alias("cells")).where(F.size(F.filter("cells", lambda c: c != "")) > 1)
    code = F.filter("cells", lambda c: c.contains("EI/") | c.startswith("EI-"))
    tax = F.filter(F.transform("cells", lambda c: ids.tax_any(c)), lambda t: t.isNotNull())
    found = full.select("doc", "pos", "cells", F.get(code, F.lit(0)).alias("ei_registration_number"), F.get(tax, F.lit(0)).alias("tax_id"))
    rest = F.filter("cells", lambda c: (F.length(c) >= 3) & ~F.coalesce(c == F.col("ei_registration_number"), F.lit(False)) & ~F.coalesce(F.upper(c).contains(F.col("tax_id")), F.lit(False)))
    longest = F.get(F.array_sort(F.transform(rest, lambda c, i: F.struct((-F.length(c)).alias("n"), i.alias("i"), c.alias("c")))), F.lit(0)).c
    named = found.select("doc", "pos", "ei_registration_number", "tax_id", text.strip(F.regexp_replace(longest, ",+$", "")).alias("entity_name"))
    return named.withColumn("legal_form_local", text.legal_form(F.col("entity_name"))).where("coalesce(ei_registration_number, tax_id, entity_name) IS NOT NULL")


def coded_records(pages: DataFrame, doc: str, body: str) -> DataFrame:
    """doc, ei_registration_number, entity_name, tax_id of running text: code, tax number and first word of the name, or code, name, tax number."""
    flat = pages.select(F.col(doc).alias("doc"), F.regexp_replace(body, r"(?U)\s+", " ").alias("t"))
    first = r"\b(EI[/-]\d+[/-]\d{4})\b\s+([A-Z]\d{7}[A-Z0-9])\s+(.+?)\s"
    second = r"\b(EI-\d{4}/\d{3}/\d)\b\s+(.+?)\s+([A-Z]\d{7}[A-Z0-9])\b"
    parts = lambda p, order: F.arrays_zip(*[F.regexp_extract_all("t", F.lit(p), F.lit(g)).alias(n) for n, g in order])
    one = parts(first, (("code", 1), ("name", 3), ("tax", 2)))
    two = parts(second, (("code", 1), ("name", 2), ("tax", 3)))
    each = flat.select("doc", F.explode(F.concat(one, two)).alias("r"))
    return each.select("doc", F.col("r.code").alias("ei_registration_number"), text.clean_text(F.col("r.name")).alias("entity_name"), F.col("r.tax").alias("tax_id"))


#: Headers of a column of names.
NAME_HEADS = ("denominación", "denominacion", "razón social", "razon social", "nombre", "empresa", "entidad")


def named_rows(pages: DataFrame, doc: str, html: str) -> DataFrame:
    """doc, pos, entity_name, tax_id: the rows below the first of a page's tables, with the name from the first column with a
    header of names (else the first column) and the tax number from the text of the row. Rows without a name fall away."""
    rows = F.transform(F.regexp_extract_all(html, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1)), lambda r: F.transform(F.regexp_extract_all(r, F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]>"), F.lit(1)), bare))
    full = pages.select(F.col(doc).alias("doc"), F.filter(rows, lambda r: F.size(r) > 0).alias("rows"))
    looks = lambda c: F.lower(c).isin(*NAME_HEADS)
    at = F.greatest(F.lit(0), F.array_position(F.transform(F.get("rows", F.lit(0)), looks), True).cast("int") - 1)
    each = full.select("doc", F.coalesce(at, F.lit(0)).alias("at"), F.posexplode(F.slice("rows", 2, 2**31 - 1)).alias("pos", "cells"))
    named = each.select("doc", "pos", text.clean_text(F.get("cells", F.col("at"))).alias("entity_name"), ids.tax_any(F.array_join("cells", " ")).alias("tax_id"))
    return named.where("entity_name IS NOT NULL")


def page_records(pages: DataFrame, doc: str, body: str) -> DataFrame:
    """doc, ei_registration_number, tax_id, entity_name: the records of a page's tables, of pages without any those that its running text shows."""
    fields = ("doc", "ei_registration_number", "tax_id", "entity_name")
    cells = table_records(html_rows(pages, doc, body)).select(*fields)
    rest = pages.select(F.col(doc).alias("doc"), bare(F.col(body)).alias("body")).join(cells.select("doc").distinct(), "doc", "left_anti")
    return cells.unionByName(coded_records(rest, "doc", "body").select(*fields))


def text_pages(texts: DataFrame, doc: str, body: str, start: int = 1) -> DataFrame:
    """doc, page, body: the pages of extracted text, parted by form feeds, from page `start` on."""
    each = texts.select(F.col(doc).alias("doc"), F.posexplode(F.split(body, "\f")).alias("page", "body"))
    return each.withColumn("page", F.col("page") + 1).where(F.col("page") >= start)


def register_hits(blocks: DataFrame, doc: str, body: str) -> DataFrame:
    """doc and the fields of a German register entry; texts without court and register number give no row, equal entries one."""
    b = collapse(F.col(body))
    kinds = "HRB|HRA|GnR|PR|VR"
    get = lambda p, g=1: F.regexp_extract(b, p, g)
    named = get(r"Firma\s*/\s*Name\s*(.+?)\s+Amtsgericht")
    before = F.regexp_extract(b, r"^(.*?)\s*Amtsgericht", 1)
    rows = blocks.select(
        F.col(doc).alias("doc"), collapse(F.when(named != "", named).otherwise(before)).alias("entity_name"), get(rf"(Amtsgericht\s+.+?)\s+(?:{kinds})\b").alias("court"), get(rf"\b({kinds})\s+(\d+)\b").alias("register_type"),
        get(rf"\b({kinds})\s+(\d+)\b", 2).alias("register_number"), get(r"\bSitz\s+([A-Za-zÄÖÜäöüß\s-]+?)\s+(?:Status|AD|CD|HD|DK|UT)\b").alias("seat"), get(r"\bEUID:\s*([A-Z0-9.]+)").alias("euid"), get(r"\bStatus:\s*([A-Za-zÄÖÜäöüß]+)").alias("status"),
    )
    fields = [c for c in rows.columns if c != "doc"]
    return rows.where("court <> '' AND register_number <> ''").groupBy(*fields).agg(F.min("doc").alias("doc"))


def listing(texts: DataFrame, doc: str, body: str, start: int = 1, dedupe: bool = False) -> DataFrame:
    """doc, rank_pos, entity_name, region, sector, source_page: the ranked rows of the pages of each text from page `start` on.

    A row belongs to the page on which it begins, wherever it goes on. dedupe keeps the first of equal rows of a text.
    """
    paged = lines(text_pages(texts, doc, body, start).withColumn("at", F.struct("doc", "page")), "at", "body")
    numbered = paged.select("doc.doc", (F.shiftleft(F.col("doc.page").cast("long"), 32) + F.col("pos")).alias("pos"), "line")
    out = ranked_rows(numbered).withColumn("source_page", F.shiftright("place", 32).cast("string")).drop("place")
    if dedupe:
        out = out.groupBy("doc", "entity_name", "region", "sector").agg(F.min_by(F.struct("rank_pos", "source_page"), "rank_pos").alias("first")).select("doc", "first.rank_pos", "entity_name", "region", "sector", "first.source_page")
    return out


def next_pages(pages: DataFrame, doc: str, html: str, url: str, wanted: str = r"/de/registerinformationen.*searchToken=") -> DataFrame:
    """source, target: the distinct full links of each page that `wanted` finds; page addresses are in column `url`."""
    found = anchors(pages, doc, html, url).where(F.col("href").rlike(wanted)).join(pages.select(F.col(doc).alias("doc"), F.col(url).alias("source")), "doc")
    return found.select("source", F.col("href").alias("target")).distinct()


def register_crawl(pages: DataFrame, url: str, html: str, seeds: DataFrame, most: int = 200) -> DataFrame:
    """The register entries of the pages that a crawl from `seeds` (address) reaches over result links, breadth first, up to `most` pages.

    pages: address and HTML as fetched. Pages that were not fetched end their branch; each entry has the page it stands on.
    """
    seen = frontier(next_pages(pages, url, html, url), seeds, most)
    reached = pages.join(seen.select(F.col("address").alias(url)), url, "left_semi")
    return register_hits(reached.withColumn("_text", bare(F.col(html))), url, "_text").withColumnRenamed("doc", "source_url")


def link_blocks(texts: DataFrame, body: str) -> DataFrame:
    """name and links (map of label to address) of blocks: a line with the name, then lines of label: address."""
    b = text.strip(F.col(body))
    return texts.select(F.trim(F.split(b, "\r?\n")[0]).alias("name"), F.map_from_entries(F.transform(F.filter(F.slice(F.split(b, "\r?\n"), 2, 1000000), lambda x: x.contains(": ")), lambda x: F.struct(F.trim(F.substring_index(x, ": ", 1)), F.trim(F.regexp_replace(x, "^[^:]*: *", ""))))).alias("links"))


def json_items(texts: DataFrame, doc: str, body: str) -> DataFrame:
    """doc, pos, item: the objects of a JSON list, of the list under items, results, posts or data of an object, or the object itself."""
    j = F.col(body)
    listed = F.coalesce(F.from_json(j, "array<string>"), *[F.from_json(F.get_json_object(j, f"$.{k}"), "array<string>") for k in ("items", "results", "posts", "data")], F.array(F.get_json_object(j, "$")))
    return texts.select(F.col(doc).alias("doc"), F.posexplode(listed).alias("pos", "item")).where("item IS NOT NULL")


def page_addresses(sources: DataFrame, url: str, start: str, end: str) -> DataFrame:
    """The address and its further pages /page/N/, N from start (at least 2) to end."""
    first = F.greatest(F.lit(2), F.col(start))
    more = F.when(F.col(end) >= first, F.transform(F.sequence(first, F.col(end)), lambda n: F.concat(F.regexp_replace(url, "/+$", ""), F.lit("/page/"), n.cast("string"), F.lit("/")))).otherwise(F.array())
    return sources.withColumn("address", F.explode(F.concat(F.array(url), more)))


def frontier(links: DataFrame, start: DataFrame, pages: int) -> DataFrame:
    """address, depth: what is reached from `start` (address) over `links` (source, target), breadth first, up to `pages` addresses."""
    from entwine.plans.durable import durable

    seen, depth = durable(start.select("address").distinct().withColumn("depth", F.lit(0))), 0
    while True:
        fresh = links.join(seen.where(F.col("depth") == depth).select(F.col("address").alias("source")), "source").select(F.col("target").alias("address")).distinct().join(seen, "address", "left_anti")
        depth += 1
        grown = durable(seen.unionByName(fresh.withColumn("depth", F.lit(depth))))
        if grown.where(F.col("depth") == depth).isEmpty() or seen.count() >= pages:
            return seen.orderBy("depth", "address").limit(pages)
        seen = grown
