"""Queries of readers, sinks and extractors: pages, files and lines made from whole tables by a fixed recipe, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from entwine.functions import ids, text
from entwine.operators import extract, matching, registers, resolve
from entwine.operators.queries import B, N, REG, S, SUP, TRU, query
from entwine.plans.durable import shared_folder
from entwine.sources import files
from entwine.sources.tables import table

#: A name of letters for a number, the same in both engines.
LETTERS = "translate(CAST({x} AS STRING), '0123456789', 'abcdefghij')"


def place(spark: SparkSession, kind: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/entwine-{kind}-{uuid.uuid4().hex}"


def flat(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table as text on one line; CSV cannot tell null from empty, so null is ''."""
    return table(spark, folder, name, *columns).select(*[F.coalesce(F.regexp_replace(F.col(c).cast("string"), r"[\r\n\t\"\\]", " "), F.lit("")).alias(c) for c in columns])


def flat_sql(*columns: str) -> str:
    return ", ".join(f"""coalesce(regexp_replace(CAST({c} AS VARCHAR), '[\\r\\n\\t"\\\\]', ' ', 'g'), '') AS {c}""" for c in columns)


def filled(df: DataFrame) -> DataFrame:
    return df.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns])


# Files written and read again.
@query("csv_headerless", f"SELECT row_id AS _c0, name AS _c1, country AS _c2 FROM (SELECT {flat_sql('row_id')}, {flat_sql(S).replace('AS ' + S, 'AS name')}, {flat_sql('supplier_country').replace('AS supplier_country', 'AS country')} FROM suppliers)")
def csv_headerless(spark: SparkSession, folder: str) -> DataFrame:
    """A supplier list without header: columns by ordinal, all text."""
    path = place(spark, "csv")
    flat(spark, folder, SUP, "row_id", S, "supplier_country").write.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("escape", '"').csv(path)
    df = filled(files.read_csv(spark, path, header=False, separators=","))
    return df.select(*[F.col(matching.column_of(df, i)).alias(f"_c{i}") for i in range(3)])


def csv_roundtrip(spark: SparkSession, df: DataFrame, **options) -> str:
    path = place(spark, "csv")
    writer = df.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    for key, value in options.items():
        writer = writer.option(key, value)
    writer.csv(path)
    return path


@query("csv_header_master", f"SELECT {flat_sql('row_id', N, 'country', 'tax_id')} FROM ei_registers_normalized")
def csv_header_master(spark: SparkSession, folder: str) -> DataFrame:
    return filled(files.read_table(spark, csv_roundtrip(spark, flat(spark, folder, REG, "row_id", N, "country", "tax_id"))))


@query("csv_robust", f"SELECT {flat_sql('row_id', B, 'sector')} FROM trusted_entities")
def csv_robust(spark: SparkSession, folder: str) -> DataFrame:
    """A CSV whose encoding and separator are found: UTF-16 with semicolons."""
    return filled(files.read_csv(spark, csv_roundtrip(spark, flat(spark, folder, TRU, "row_id", B, "sector"), sep=";", encoding="UTF-16")))


@query("csv_required", f"SELECT {flat_sql('row_id', B, 'country_hint')} FROM trusted_entities")
def csv_required(spark: SparkSession, folder: str) -> DataFrame:
    """The separator that shows the required columns."""
    return filled(files.read_csv(spark, csv_roundtrip(spark, flat(spark, folder, TRU, "row_id", B, "country_hint"), sep="|"), required=["RAW_BRAND_NAME", "country_hint"]))


@query("csv_quote_all", f"SELECT {flat_sql('row_id', B, 'website_hint')}, count(*) OVER () AS written FROM trusted_entities")
def csv_quote_all(spark: SparkSession, folder: str) -> DataFrame:
    """The sink that quotes every field and counts its rows, appended to in two parts, read again."""
    df, path = flat(spark, folder, TRU, "row_id", B, "website_hint"), place(spark, "csv")
    half = F.col("row_id").cast("long") % 2 == 0
    rows = files.write_csv(df.where(half), path, quote_all=True) + files.write_csv(df.where(~half), path, quote_all=True, append=True, fields=["row_id", B, "website_hint"])
    return filled(files.read_csv(spark, path)).withColumn("written", F.lit(rows).cast("bigint"))


@query("parquet_table", "SELECT row_id, country, tax_id_root FROM ei_registers_normalized")
def parquet_table(spark: SparkSession, folder: str) -> DataFrame:
    return files.read_table(spark, f"{folder}/{REG}.parquet").select("row_id", "country", "tax_id_root")


@query("catalogue_csv_source", f"SELECT row_id AS ei_registration_number, {text.clean_text_sql('name')} AS entity_name, 'ES' AS country, 'CSV' AS source_type FROM (SELECT {flat_sql('row_id')}, {flat_sql(S).replace('AS ' + S, 'AS name')} FROM suppliers)")
def catalogue_csv_source(spark: SparkSession, folder: str) -> DataFrame:
    """A CSV source of a YAML catalogue, mapped; a switched-off source is not read."""
    import yaml

    path = csv_roundtrip(spark, flat(spark, folder, SUP, "row_id", S).withColumnRenamed(S, "Razón  Social"), sep=";")
    listed = yaml.safe_dump({"sources": [{"country": "ES", "type": "CSV", "name": "List", "url": path, "mapping": {"entity_name": ["nombre", "RAZÓN SOCIAL"], "ei_registration_number": ["row_id"]}}, {"country": "FR", "type": "CSV", "url": "none.csv", "enabled": False}]})
    sources = files.catalogue_of(listed)
    return registers.run(spark, sources, {"CSV": lambda s, x: files.read_csv(s, files.located(x["url"]))}, "2024-01-31")[0].select("ei_registration_number", N, "country", "source_type")


@query("xlsx_sheet", f"SELECT {flat_sql('row_id', B, 'country_hint')} FROM trusted_entities")
def xlsx_sheet(spark: SparkSession, folder: str) -> DataFrame:
    """Spreadsheets of the roster, one per batch of rows, written and read again."""
    df = flat(spark, folder, TRU, "row_id", B, "country_hint")
    return filled(files.xlsx_rows(files.to_xlsx(df), df.columns))


@query("xlsx_fr_siren", f"SELECT {ids.siren_of_sheet_sql('_c3')} AS tax_id, {text.clean_text_sql(S)} AS entity_name FROM suppliers WHERE {ids.siren_of_sheet_sql('_c3')} IS NOT NULL AND {text.clean_text_sql(S)} IS NOT NULL")
def xlsx_fr_siren(spark: SparkSession, folder: str) -> DataFrame:
    """French sheet rows with a name and a SIREN of nine digits; the others are skipped."""
    return registers.siren_rows(table(spark, folder, SUP, S, "_c3"), S, "_c3").select("tax_id", N)


@query("roster_headers", f"SELECT {B} AS raw_brand_name, coalesce(country_hint, '') AS country_hint, 'TRUSTED_ROSTER' AS source FROM trusted_entities")
def roster_headers(spark: SparkSession, folder: str) -> DataFrame:
    """A roster file with other headers."""
    rows = table(spark, folder, TRU).select(F.col(B).alias("Organisation"), F.coalesce("country_hint", F.lit("")).alias("COUNTRY"))
    return resolve.roster_columns(rows).select(B, "country_hint", "source")


@query("directory_rows", f"SELECT row_id, {text.strip_sql(B)} AS raw_brand_name, 'published' AS publish_status, 'DIRECTORY_V22' AS source, coalesce(sector, '') AS sector FROM trusted_entities WHERE coalesce({text.strip_sql(B)}, '') <> ''")
def directory_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, TRU)
    named = rows.select("row_id", *[F.col(c).alias(h) for h, c in resolve.DIRECTORY.items()])
    return resolve.directory_rows(named).select("row_id", B, "publish_status", "source", "sector")


@query("default_mapping", f"SELECT {S} AS entity_name, coalesce(nullif({text.strip_sql('_c3')}, ''), {ids.tax_any_sql(S)}) AS tax_id FROM suppliers")
def default_mapping(spark: SparkSession, folder: str) -> DataFrame:
    """A source without mapping: its name column and tax number by their headers."""
    return registers.default_mapping(table(spark, folder, SUP).select("row_id", F.col(S).alias("Nombre"), F.col("_c3").alias("CIF/NIF")))


@query("clean_headers", "SELECT row_id, country AS \"razón social\", city AS \"razón social_2\" FROM ei_registers_normalized")
def clean_headers(spark: SparkSession, folder: str) -> DataFrame:
    return registers.clean_headers(table(spark, folder, REG, "row_id", "country", "city").toDF("row_id", " Razón  Social", "RAZÓN SOCIAL "))


@query("status_filter", f"SELECT row_id, {text.strip_sql(B)} AS brand FROM trusted_entities WHERE publish_status IN ('published', 'draft', 'PUBLISHED', 'DRAFT') AND {text.strip_sql(B)} <> ''")
def status_filter(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, TRU, "row_id", B, "publish_status").where(F.col("publish_status").isin("published", "draft", "PUBLISHED", "DRAFT"))
    return rows.select("row_id", text.strip(F.col(B)).alias("brand")).where("brand <> ''")


@query("brand_containment", f"SELECT DISTINCT s.row_id FROM suppliers s JOIN trusted_entities t ON {text.strip_sql(B)} <> '' AND contains(lower({S}), lower({text.strip_sql(B)}))")
def brand_containment(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers whose name contains a brand of the roster, by an inverted index of runs of letters."""
    return matching.contained(table(spark, folder, SUP), "row_id", S, table(spark, folder, TRU, B), B)


# Pages and lines, one per row of a table.
def pages(spark: SparkSession, folder: str, body: str) -> DataFrame:
    """row_id, url, body (an SQL text over row_id, name, tax) of every register row; signs of markup are taken out of names."""
    rows = table(spark, folder, REG).select("row_id", F.lit("http://x.org/y/").alias("url"), F.translate(F.coalesce(N, F.lit("")), "<>&\r\n\t", "").alias("name"), F.coalesce("tax_id", F.lit("")).alias("tax"))
    return rows.select("row_id", "url", F.expr(body).alias("body"))


NAME_SQL = "translate(coalesce(entity_name, ''), '<>&' || chr(13) || chr(10) || chr(9), '')"
TIDY_SQL = text.strip_sql(rf"regexp_replace(replace({NAME_SQL}, chr(160), ' '), '[\s\p{{Z}}]+', ' ', 'g')")


@query("html_anchors", f"SELECT row_id AS doc, 0 AS pos, {TIDY_SQL} AS label, 'http://x.org/a' || row_id || '.pdf' AS href FROM ei_registers_normalized UNION ALL SELECT row_id, 1, 'More', 'http://b.org/c?' || row_id FROM ei_registers_normalized")
def html_anchors(spark: SparkSession, folder: str) -> DataFrame:
    body = """concat('<p><a class=x href="/a', row_id, '.pdf"><b>', name, '</b></a> and <A HREF=''http://b.org/c?', row_id, '''>More</A></p>')"""
    return extract.anchors(pages(spark, folder, body), "row_id", "body", "url").withColumn("pos", F.col("pos").cast("int"))


@query("pdf_links", "SELECT row_id AS doc, 0 AS pos, 'http://x.org/a' || row_id || '.pdf' AS href FROM ei_registers_normalized UNION ALL SELECT row_id, 3, 'http://x.org/y/d' || row_id || '.PDF?v=1' FROM ei_registers_normalized")
def pdf_links(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct links to PDF files in their order."""
    body = """concat('<a href="/a', row_id, '.pdf">A</a><a href="/z.html">Z</a><a href="/a', row_id, '.pdf">A</a><a href="d', row_id, '.PDF?v=1">D</a>')"""
    return extract.pdf_links(pages(spark, folder, body), "row_id", "body", "url")


@query("html_table_source", f"SELECT row_id AS doc, {TIDY_SQL} AS entity_name, {ids.tax_any_sql(f"concat_ws(' ', CASE WHEN row_id % 2 = 0 THEN 'B' || lpad((row_id % 10000000)::VARCHAR, 7, '0') || 'A' ELSE 'none' END, {TIDY_SQL})")} AS tax_id FROM ei_registers_normalized WHERE {TIDY_SQL} <> ''")
def html_table_source(spark: SparkSession, folder: str) -> DataFrame:
    """Tables of pages as rows: the name by its header, the tax number from the text of the row."""
    body = """concat('<table><tr><th>Datos</th><th>Nombre</th></tr><tr><td>', IF(row_id % 2 = 0, concat('B', lpad(CAST(row_id % 10000000 AS STRING), 7, '0'), 'A'), 'none'), '</td><td><b>', name, '</b></td></tr></table>')"""
    return extract.named_rows(pages(spark, folder, body), "row_id", "body").select("doc", N, "tax_id")


CODE = "'EI-2007/' || lpad((row_id % 1000)::VARCHAR, 3, '0') || '/1'"
TAXNO = "'B' || lpad((row_id % 10000000)::VARCHAR, 7, '0') || 'A'"


@query("pdf_source", f"SELECT row_id AS doc, {CODE} AS ei_registration_number, 'Taller ' || {LETTERS.format(x='row_id')} AS entity_name, {TAXNO} AS tax_id FROM ei_registers_normalized".replace("STRING", "VARCHAR"))
def pdf_source(spark: SparkSession, folder: str) -> DataFrame:
    """Pages with a table are read by its cells, pages without by their codes."""
    code, tax, name = "'EI-2007/', lpad(CAST(row_id % 1000 AS STRING), 3, '0'), '/1'", "'B', lpad(CAST(row_id % 10000000 AS STRING), 7, '0'), 'A'", f"'Taller ', {LETTERS.format(x='row_id')}"
    body = f"IF(row_id % 2 = 0, concat('<table><tr><td>', {code}, '</td><td>', {name}, '</td><td>', {tax}, '</td></tr></table>'), concat({code}, ' ', {name}, ' ', {tax}, ' end'))"
    return extract.page_records(pages(spark, folder, body), "row_id", "body").select("doc", "ei_registration_number", N, "tax_id")


@query("text_pages_from", r"SELECT doc_id AS doc, page::INT AS page, body FROM (SELECT doc_id, unnest(generate_series(1, len(string_split(text, chr(10))))) AS page, unnest(string_split(text, chr(10))) AS body FROM documents WHERE text IS NOT NULL) WHERE page >= 2")
def text_pages_from(spark: SparkSession, folder: str) -> DataFrame:
    """The pages of each text from the second on; here each line is a page."""
    broken = table(spark, folder, "documents", "doc_id", "text").withColumn("text", F.replace("text", F.lit("\n"), F.lit("\f")))
    return extract.text_pages(broken, "doc_id", "text", 2)


@query("german_workshops", f"SELECT row_id AS doc, 'Werkhof ' || {LETTERS.format(x='row_id')} AS entity_name, 'Gartenweg ' || (row_id % 90 + 1) AS address, lpad((row_id % 90000 + 10000)::VARCHAR, 5, '0') AS postcode, 'Stadt' AS city, CASE WHEN row_id % 3 = 0 THEN 'www.w' || row_id || '.de' END AS website FROM ei_registers_normalized".replace("STRING", "VARCHAR"))
def german_workshops(spark: SparkSession, folder: str) -> DataFrame:
    """Name, street, postcode with town, and here and there a website, line by line; each entry stands there twice."""
    entry = f"'Werkhof ', {LETTERS.format(x='row_id')}, '\\nGartenweg ', row_id % 90 + 1, '\\n', lpad(CAST(row_id % 90000 + 10000 AS STRING), 5, '0'), ' Stadt\\n', IF(row_id % 3 = 0, concat('www.w', row_id, '.de\\n'), '')"
    listed = extract.lines(pages(spark, folder, f"concat('LISTE\\n', {entry}, {entry})"), "row_id", "body")
    return extract.german_workshops(listed).select("doc", N, "address", "postcode", "city", "website")


@query("austrian_workshops", f"SELECT row_id AS doc, CASE row_id % 2 WHEN 0 THEN 'Wien' ELSE 'Tirol' END AS region, 'Werk ' || {LETTERS.format(x='row_id')} || ' GmbH' AS entity_name, lpad((row_id % 9000 + 1000)::VARCHAR, 4, '0') AS postcode, 'Ort' AS city FROM ei_registers_normalized".replace("STRING", "VARCHAR"))
def austrian_workshops(spark: SparkSession, folder: str) -> DataFrame:
    """The same with a state as heading and a legal form in the name."""
    body = f"concat(IF(row_id % 2 = 0, 'Wien', 'Tirol'), '\\nMehr Informationen\\nWerk ', {LETTERS.format(x='row_id')}, ' GmbH\\nHauptplatz 3\\n', lpad(CAST(row_id % 9000 + 1000 AS STRING), 4, '0'), ' Ort\\n')"
    return extract.austrian_workshops(extract.lines(pages(spark, folder, body), "row_id", "body")).select("doc", "region", N, "postcode", "city")


@query("verified_links", f"SELECT row_id AS doc, 'Haus ' || {LETTERS.format(x='row_id')} || ' ' || n AS entity_name, 'http://x.org/y/e' || n AS website, 'Label' AS se_recognition_type FROM ei_registers_normalized, (SELECT unnest(['a', 'b', 'c', 'd', 'e', 'f']) AS n)".replace("STRING", "VARCHAR"))
def verified_links(spark: SparkSession, folder: str) -> DataFrame:
    """Six links with names on each page; menu entries, mail and photo credits are none."""
    links = ", ".join(f"""'<a href="/e{n}">Haus ', {LETTERS.format(x='row_id')}, ' {n}</a>'""" for n in "abcdef")
    body = f"""concat('<a href="/k">Kontakt</a><a href="mailto:a@b.c">Anna Meier</a><a href="/f">Foto (c) X</a>', {links})"""
    return extract.verified_links(pages(spark, folder, body), "row_id", "body", "url").select("doc", N, "website", "se_recognition_type")


@query("register_hits", f"SELECT row_id AS doc, 'Sol ' || {LETTERS.format(x='row_id')} || ' eG' AS entity_name, 'Amtsgericht Hamburg' AS court, 'GnR' AS register_type, row_id::VARCHAR AS register_number, 'aktuell' AS status FROM ei_registers_normalized".replace("STRING", "VARCHAR"))
def register_hits(spark: SparkSession, folder: str) -> DataFrame:
    body = f"concat('Firma / Name Sol ', {LETTERS.format(x='row_id')}, ' eG Amtsgericht Hamburg GnR ', row_id, ' Sitz Hamburg Status: aktuell EUID: DEK.', row_id)"
    return extract.register_hits(pages(spark, folder, body), "row_id", "body").select("doc", N, "court", "register_type", "register_number", "status")


@query("link_blocks", f"SELECT {TIDY_SQL} AS name, 'http://a.b/' || row_id || ': x' AS page FROM ei_registers_normalized")
def link_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Blocks of a name and lines of label and address."""
    blocks = pages(spark, folder, "concat(name, '\\nPage: http://a.b/', row_id, ': x\\nOther: none\\n')")
    return extract.link_blocks(blocks.withColumn("body", F.concat(F.lit("\n"), "body")), "body").select(extract.collapse(F.col("name")).alias("name"), F.col("links")["Page"].alias("page"))


@query("crawl_frontier", "WITH RECURSIVE r(address) AS (SELECT 'p0' UNION SELECT 'p' || c FROM r JOIN (SELECT o_orderkey AS c, o_orderkey // 3 AS p FROM orders UNION ALL SELECT o_orderkey // 3, o_orderkey FROM orders) e ON address = 'p' || p) SELECT address FROM r")
def crawl_frontier(spark: SparkSession, folder: str) -> DataFrame:
    """All pages that a crawl reaches over links between the orders' keys, breadth first."""
    orders = table(spark, folder, "orders", "o_orderkey").select(F.concat(F.lit("p"), F.expr("o_orderkey DIV 3")).alias("source"), F.concat(F.lit("p"), "o_orderkey").alias("target"))
    links = orders.unionByName(orders.select(F.col("target").alias("source"), F.col("source").alias("target")))
    return extract.frontier(links, spark.createDataFrame([("p0",)], "address string"), 2**31 - 1).select("address")


@query("ranked_listing", f"SELECT row_id AS doc, 'SOL ' || upper({LETTERS.format(x='row_id')}) || ' LUNA' AS entity_name, CASE WHEN row_id % 2 = 0 THEN 'GALICIA' ELSE 'COMUNIDAD VALENCIANA' END AS region, 'PESCA' AS sector FROM ei_registers_normalized".replace("STRING", "VARCHAR"))
def ranked_listing(spark: SparkSession, folder: str) -> DataFrame:
    """A ranked line with name, sector, amount, region and size, continued by a second line; noise before it."""
    body = f"concat('Nº NOMBRE\\nCOOPERATIVAS\\n7 SOL ', upper({LETTERS.format(x='row_id')}), ' PESCA 1.234 5,6', IF(row_id % 2 = 0, ' GALICIA', ''), ' GRAN EMPRESA\\nLUNA\\n', IF(row_id % 2 = 0, '', 'VALENCIANA\\n'))"
    return extract.ranked_rows(extract.lines(pages(spark, folder, body), "row_id", "body")).select("doc", N, "region", "sector")


@query("paged_listing", f"SELECT row_id AS doc, 'SOL ' || upper({LETTERS.format(x='row_id')}) || ' LUNA' AS entity_name, 'GALICIA' AS region, 'SALUD' AS sector, '3' AS source_page FROM ei_registers_normalized".replace("STRING", "VARCHAR"))
def paged_listing(spark: SparkSession, folder: str) -> DataFrame:
    """A listing over pages: read from the second on, a row that goes on behind the page's end, and the same row again."""
    row = f"'4 SOL ', upper({LETTERS.format(x='row_id')}), ' SALUD 12,5 GALICIA PEQUEÑA EMPRESA', char(12), 'LUNA\\n'"
    body = f"concat('1 NOT READ PESCA', char(12), 'Nº NOMBRE', char(12), {row}, {row})"
    return extract.listing(pages(spark, folder, body), "row_id", "body", 2, dedupe=True).select("doc", N, "region", "sector", "source_page")


@query("register_crawl", """
WITH RECURSIVE e AS (SELECT o_orderkey AS c, o_orderkey // 3 AS p FROM orders), r(k) AS (SELECT 0 UNION SELECT c FROM r JOIN e ON p = k)
SELECT 'http://r.org/de/registerinformationen?searchToken=' || k AS source_url, 'Sol ' || translate(k::VARCHAR, '0123456789', 'abcdefghij') AS entity_name, k::VARCHAR AS register_number FROM r WHERE k IN (SELECT o_orderkey FROM orders)
""")
def register_crawl(spark: SparkSession, folder: str) -> DataFrame:
    """Result pages that link to the next ones, crawled from one seed, and the entries on them."""
    orders = table(spark, folder, "orders", "o_orderkey").distinct()
    address = lambda x: F.concat(F.lit("http://r.org/de/registerinformationen?searchToken="), x.cast("string"))
    link = F.concat(F.lit('<a href="/de/registerinformationen?searchToken='), F.col("o_orderkey").cast("string"), F.lit('">next</a><a href="/de/hilfe">x</a>'))
    nexts = orders.select(F.expr("o_orderkey DIV 3").alias("k"), link.alias("link")).groupBy("k").agg(F.array_join(F.collect_list("link"), "").alias("links"))
    entry = F.concat(F.lit("<p>Firma / Name Sol "), F.expr(LETTERS.format(x="o_orderkey")), F.lit(" Amtsgericht Hamburg HRB "), F.col("o_orderkey").cast("string"), F.lit("</p>"))
    whole = orders.select(F.col("o_orderkey").alias("k"), entry.alias("entry")).join(nexts, "k", "full")
    fetched = whole.select(address(F.col("k")).alias("url"), F.concat(F.coalesce("entry", F.lit("")), F.coalesce("links", F.lit(""))).alias("html"))
    seeds = spark.createDataFrame([("http://r.org/de/registerinformationen?searchToken=0",)], "address string")
    return extract.register_crawl(fetched, "url", "html", seeds, 2**31 - 1).select("source_url", N, "register_number")


@query("absolute_links", "SELECT row_id, 'http://x.org/p/' || row_id AS link FROM trusted_entities")
def absolute_links(spark: SparkSession, folder: str) -> DataFrame:
    """Links that are full, begin at the host or beside the page."""
    href = F.expr("CASE row_id % 3 WHEN 0 THEN concat('/p/', row_id) WHEN 1 THEN cast(row_id AS string) ELSE concat('http://x.org/p/', row_id) END")
    return table(spark, folder, TRU, "row_id").select("row_id", ids.absolute(F.lit("http://x.org/p/page.html"), href).alias("link"))


@query("numeric_tails", f"SELECT row_id, 'Sol ' || {LETTERS.format(x='row_id')} AS value FROM ei_registers_normalized".replace("STRING", "VARCHAR"))
def numeric_tails(spark: SparkSession, folder: str) -> DataFrame:
    """Names before amounts with and without thousands points."""
    said = F.expr(f"concat('Sol ', {LETTERS.format(x='row_id')}, IF(row_id % 2 = 0, ' 1.234.567,8 € 12', ' 12,5 € x 3'))")
    return table(spark, folder, REG, "row_id").select("row_id", extract.numeric_tail_cut(said).alias("value"))


@query("first_best", "SELECT country, min_by(row_id, row_id) FILTER (WHERE n = top) AS row_id, max(n) AS filled FROM (SELECT *, max(n) OVER (PARTITION BY country) AS top FROM (SELECT row_id, country, CASE WHEN coalesce(trim(city), '') <> '' THEN 1 ELSE 0 END + CASE WHEN coalesce(trim(tax_id), '') <> '' THEN 1 ELSE 0 END AS n FROM ei_registers_normalized)) GROUP BY 1")
def first_best(spark: SparkSession, folder: str) -> DataFrame:
    """The best row of each group, the first among equals, by one aggregation."""
    rows = table(spark, folder, REG, "row_id", "country", "city", "tax_id").withColumn("filled", sum((F.when(F.coalesce(F.trim(c), F.lit("")) != "", 1).otherwise(0) for c in ("city", "tax_id")), F.lit(0)))
    best = F.max_by(F.struct("row_id", "filled"), F.struct("filled", -F.col("row_id")))
    return rows.groupBy("country").agg(best.alias("b")).select("country", "b.row_id", "b.filled")


@query("carried_forward", "SELECT line_id, last_value(CASE WHEN line_no = 1 THEN raw_line END IGNORE NULLS) OVER (PARTITION BY file_name ORDER BY line_no, line_id) AS header FROM raw_roster_lines")
def carried_forward(spark: SparkSession, folder: str) -> DataFrame:
    """The header that holds for each line of a file."""
    so_far = Window.partitionBy("file_name").orderBy("line_no", "line_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return table(spark, folder, "raw_roster_lines").select("line_id", F.last(F.when(F.col("line_no") == 1, F.col("raw_line")), ignorenulls=True).over(so_far).alias("header"))
