import random

import pytest
from pyspark.sql import functions as F

from entwine.functions.similarity import partial_ratio, weighted_ratio
from entwine.operators import extract, matching, nearest, packed, parse, registers, resolve
from entwine.sources import files

HEAD = "raw_brand_name;country_hint;website_hint;publish_status;updated_on"


def reasons(spark, lines, head=HEAD):
    rows = [(0, "f", 1, head), *[(i, "f", i + 1, x) for i, x in enumerate(lines, 1)]]
    df = parse.parse_lines(spark.createDataFrame(rows, "line_id long, file_name string, line_no int, raw_line string"))
    return {r.line_id: r.reason for r in parse.rejected(df, parse.ROSTER_RULES).collect()}, df


def test_lines_that_fail(spark):
    good = ["A;ES;;;", '"A; ""B""";;www.a.es;Draft;2024-02-29', "A;;HTTP://a-b.c:80/x?y=1;published;\r", '"A\nB";;"";;', '"""";;;;'.replace('""""', '"""A"""'), "A\u0001S;;;;"]
    bad = {"A;ES;;": "column_count", '"A" B;;;;': "quoting", 'A "B";;;;': "quoting", '"A;;;;': "quoting", '"""";;;;': "invalid_value", ";;;;": "invalid_value", "A;;a..es;;": "invalid_value", "A;;a es;;": "invalid_value", "A;;;gone;": "invalid_value", "A;;;;2023-02-29": "invalid_value", None: "column_count", "": "column_count", "x" * 100_000 + '"': "quoting"}
    found, df = reasons(spark, [*good, *bad])
    assert found == {len(good) + 1 + i: r for i, r in enumerate(bad.values())}
    errors = parse.rejected(df, parse.ROSTER_RULES)
    rows = {r.line_id: r for r in parse.accepted(df, errors, ["raw_brand_name", "website_hint", "lacking"]).collect()}
    assert set(rows) == set(range(1, len(good) + 1))
    assert rows[2].raw_brand_name == 'A; "B"' and rows[4].raw_brand_name == "A\nB" and rows[6].raw_brand_name == "A\u0001S" and rows[1].lacking is None


def test_headers_with_one_name(spark):
    found, df = reasons(spark, ["A;B;x"], "raw_brand_name;raw_brand_name;sector")
    assert not found and [tuple(r)[3:] for r in parse.accepted(df, parse.rejected(df, parse.ROSTER_RULES), ["raw_brand_name", "sector", "none"]).collect()] == [("A", "x", None)]


def test_lines_without_header_or_rows(spark):
    found, df = reasons(spark, [])
    assert found == {}
    lone = spark.createDataFrame([(1, "g", 2, "a;b")], "line_id long, file_name string, line_no int, raw_line string")
    assert [r.reason for r in parse.rejected(parse.parse_lines(lone), parse.ROSTER_RULES).collect()] == ["column_count"]


def test_packed_fields(spark):
    names = ["Alder Bank", "Umberley Rail", "Dunmoor Foods", "Corvane Hotels", "Greyholm Energy", "Oakhaven Council"]
    rows, n = [], 0
    for a in names:
        for b in names:
            for sep in ("; ", ",", "\t", " | "):
                n += 1
                rows.append((n, f"{a}{sep}{b}", None))
        n += 1
        rows.append((n, a, None))
    company = "Alder, Umberley & Co"
    special = [f"{company}; Dunmoor Foods", company, f'"{company}", "The ""Alder"" Circle"', '["Alder Bank", "Corvane Hotels"]', "* Alder Bank\n* Alder Bank", "1) Alder Bank 2) Umberley Rail", "; Alder Bank;;Umberley Rail;", " ", None, "Alder Bank"]
    first = n + 1
    rows += [(first + i, x, None) for i, x in enumerate(special)] + [(9000 + i, f"{company}|{x}", None) for i, x in enumerate(names)]
    df = spark.createDataFrame(rows, "row_id long, a string, b string")
    got = packed.unpack(df, "row_id", ["a", "b"]).toPandas().sort_values(["row_id", "pos"])
    by = got.groupby("row_id").item.apply(list).to_dict()
    want = [[company, "Dunmoor Foods"], None, [company, 'The "Alder" Circle'], ["Alder Bank", "Corvane Hotels"], ["Alder Bank", "Alder Bank"], ["Alder Bank", "Umberley Rail"], ["Alder Bank", "Umberley Rail"], None, None, None]
    assert [by.get(first + i) for i in range(len(special))] == want
    assert by[1] == ["Alder Bank", "Alder Bank"] and all(len(by[i]) == 2 for i in range(9000, 9006))
    assert packed.unpack(df.limit(0), "row_id", ["a"]).count() == 0


def test_cascade(spark):
    master = spark.createDataFrame(
        [(1, "ES", "N", "Taller Solidario Norte", "B1", "R"), (2, "ES", "N", "Taller Solidario Norte", "B1", "R2"), (3, "FR", "", "Atelier Vert", "123456789", "F"), (4, "ES", "", "Asociación Sol Naciente", None, "R")],
        "row_id long, country string, ccaa string, entity_name string, tax_id_root string, ei_register_name string",
    )
    suppliers = spark.createDataFrame(
        [(1, "x", "es", "b-1"), (2, "Atelier", "FR", "12345678900017"), (3, "Taller Solidari Norte", "ES", None), (4, " Column2", "ES", None), (5, None, "ES", None), (6, "Cooperativa Asociacion Sol Naciente", "ES", ""), (7, "Taller Solidario Norte", None, None), (8, "Taller Solidario Norte S.A.", "ES", None), (1, "x", "es", "b-1")],
        "row_id long, _supplier_raw_name string, supplier_country string, _c3 string",
    )
    sides = matching.prepared(suppliers, "row_id", "_supplier_raw_name", "supplier_country", "_c3"), matching.register(master, "row_id")
    out = matching.match(*sides)
    assert "CartesianProduct" not in out._jdf.queryExecution().toString() and "NestedLoop" not in out._jdf.queryExecution().toString()
    got = {r.s_key: (r.match_type, r.match_score, r.matched_register) for r in out.collect()}
    assert got == {1: ("tax_id_exact", 100, "R"), 2: ("tax_id_siren_bridge", 98, "F"), 3: ("name_fuzzy", 97, "R"), 6: (None, None, None), 7: ("name_fuzzy", 99, "R"), 8: (None, None, None)}
    assert out.count() == 7
    assert matching.match(sides[0].limit(0), sides[1]).count() == 0
    assert matching.column_of(suppliers, "1") == "_supplier_raw_name"
    with pytest.raises(ValueError):
        matching.column_of(suppliers, "none")


def test_roster_and_mapping(spark):
    a = spark.createDataFrame([(1, "Group Ilunion", "", None), (2, "Sol", "", "x")], "row_id long, raw_brand_name string, sector string, website_hint string")
    b = spark.createDataFrame([(3, "GRUPO ILUNION", "y"), (4, "sol", "z"), (5, " ", "z")], "row_id long, raw_brand_name string, sector string")
    got = {r.roster_key: r.row_id for r in resolve.rebuild_roster([(a, 2), (b, 1)]).collect()}
    assert got == {"ilunion": 1, "sol": 2}
    df = registers.clean_headers(spark.createDataFrame([("A", "B", "C")], ["  Razón   Social ", "CIF", "cif"]))
    assert df.columns == ["razón social", "cif", "cif_2"]
    assert registers.apply_mapping(df, {"entity_name": ["x", "RAZÓN SOCIAL"], "tax_id": ["CIF"], "city": []}).columns == ["entity_name", "tax_id"]
    assert registers.default_mapping(df).first().asDict() == {"entity_name": "A", "tax_id": "B"}
    with pytest.raises(ValueError):
        registers.require(df, ["lacking"])


def test_extraction(spark):
    page = spark.createDataFrame([(1, '<table><tr><th>Nº</th></tr><tr><td>EI/1</td><td>B12345678</td><td>Taller <b>Sol</b>, S.L.,</td></tr></table><a href="/a.pdf">A</a><a class=x href="http://b.org/b.PDF?x">B</a><a href="/a.pdf">again</a>', "http://x.org/y/")], "id long, html string, url string")
    assert [r.asDict() for r in extract.table_records(extract.html_rows(page, "id", "html")).drop("doc", "pos").collect()] == [{"ei_registration_number": "EI/1", "tax_id": "B12345678", "entity_name": "Taller Sol, S.L.", "legal_form_local": "S.L."}]
    assert {r.href for r in extract.pdf_links(page, "id", "html", "url").collect()} == {"http://x.org/a.pdf", "http://b.org/b.PDF?x"}
    text = spark.createDataFrame([(1, "Nº NOMBRE\nx\n1 SOL NACIENTE SERVICIOS 1.234 5,6 GRAN EMPRESA\nY LUNA\n2 MAR PESCA GALICIA PEQUEÑA EMPRESA\n3 RIO 12\nVALENCIANA")], "id long, t string")
    got = [(r.entity_name, r.region, r.sector) for r in extract.ranked_rows(extract.lines(text, "id", "t")).orderBy("rank_pos").collect()]
    assert got == [("SOL NACIENTE Y LUNA", "", "SERVICIOS"), ("MAR", "GALICIA", "PESCA"), ("RIO", "COMUNIDAD VALENCIANA", "")]
    shops = spark.createDataFrame([(1, "LISTE\nWerkhof eG\nGartenweg 3\n68199 Mannheim\nwww.werkhof.de\nBad Laden\nAm Markt 1, 70173 Stuttgart\nWerkhof eG\nGartenweg 3\n68199 Mannheim")], "id long, t string")
    got = [(r.entity_name, r.address, r.postcode, r.city, r.website) for r in extract.german_workshops(extract.lines(shops, "id", "t")).orderBy("pos").collect()]
    assert got == [("Werkhof eG", "Gartenweg 3", "68199", "Mannheim", "www.werkhof.de"), ("Bad Laden", "Am Markt 1,", "70173", "Stuttgart", None)]
    hits = spark.createDataFrame([(1, "Firma / Name Sol eG Amtsgericht Hamburg HRB 12 Sitz Hamburg Status: aktuell EUID: DEK.1"), (2, "nothing")], "id long, t string")
    row = extract.register_hits(hits, "id", "t").collect()
    assert [(r.entity_name, r.court, r.register_type, r.register_number, r.seat, r.euid, r.status) for r in row] == [("Sol eG", "Amtsgericht Hamburg", "HRB", "12", "Hamburg", "DEK.1", "aktuell")]
    coded = spark.createDataFrame([(1, "EI/005/2011 B12345678 TALLER SOL x EI-2007/040/1 LUNA SL B87654321 ")], "id long, t string")
    assert {(r.ei_registration_number, r.entity_name, r.tax_id) for r in extract.coded_records(coded, "id", "t").collect()} == {("EI/005/2011", "TALLER", "B12345678"), ("EI-2007/040/1", "LUNA SL", "B87654321")}
    block = spark.createDataFrame([("Sol\nSeite: http://a.b: x\nZwei: y",)], "t string")
    assert extract.link_blocks(block, "t").first().links == {"Seite": "http://a.b: x", "Zwei": "y"}
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "source string, target string")
    assert [r.address for r in extract.frontier(links, spark.createDataFrame([("a",)], "address string"), 9).collect()] == ["a", "b", "c"]


def test_files(spark, tmp_path):
    path = str(tmp_path / "a.csv")
    with open(path, "w", encoding="cp1252") as f:
        f.write("Name;Tax\nCafé;1\n")
    assert [tuple(r) for r in files.read_csv(spark, path).collect()] == [("Café", "1")]
    assert files.read_csv(spark, path, required=["TAX"]).columns == ["Name", "Tax"]
    with pytest.raises(ValueError):
        files.read_csv(spark, path, required=["none"])
    assert files.write_csv(spark.createDataFrame([("x", 'q"')], ["a", "b"]), str(tmp_path / "out"), quote_all=True, single=True) == 1
    import zipfile

    sheet = '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C1" t="inlineStr"><is><t>Tax</t></is></c></row><row><c r="A2"><v>7</v></c></row></sheetData></worksheet>'
    with zipfile.ZipFile(tmp_path / "a.xlsx", "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", sheet)
        z.writestr("xl/sharedStrings.xml", '<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><si><t>Name</t></si></sst>')
    df = files.read_table(spark, str(tmp_path / "a.xlsx"))
    assert df.columns == ["Name", "_c1", "Tax"] and tuple(df.first()) == ("7", None, None)


def test_registry_loads_without_session():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_resolvers_against_brute_force(spark):
    import random
    import re

    from entwine.functions.similarity import partial_ratio, weighted_ratio
    from entwine.functions.values import STOP_TOKENS

    rng = random.Random(7)
    pool = ["taller", "solar", "grupo", "verde", "norte", "luna", "sol", "cooperativa", "añil", "x"]
    name = lambda: " ".join(rng.choice(pool) + rng.choice(["", "", "s"]) for _ in range(rng.randint(1, 3)))
    master = [(i, rng.choice(["ES", "FR"]), name(), f"e{i}", rng.choice(["", "a.es", "b.es"])) for i in range(60)] + [(90, "ES", None, "e90", None), (91, "ES", "sin id", None, "")]
    roster = [(i, name(), rng.choice(["es ", "FR", "DE", ""]), rng.choice([None, "http://www.a.es/x", "b.es", "c.es"])) for i in range(60)] + [(80, None, "ES", None), (81, "sol", None, None), (82, "x", "ES", None), (83, "", "ES", "a.es"), (80, None, "ES", None)]
    m = spark.createDataFrame([(i, c, n, n, e, w, "extra") for i, c, n, e, w in master], "row_id long, country string, entity_name string, entity_name_norm string, entity_id string, website string, order string")
    r = spark.createDataFrame(roster, "row_id long, raw_brand_name string, country_hint string, website_hint string")
    rows = [(i, c, n or "", e) for i, c, n, e, _ in master if e]
    letters = lambda s: re.sub("[^a-z0-9]", "", s)[:4]
    score = lambda a, b: round(weighted_ratio(a, b), 6)
    blocks = resolve.resolve_by_blocks(r, m, widen=3, most=4, k=2)
    got = {x.r_key: x for x in blocks.collect()}
    for i, n, land, _ in roster:
        n, land = n or "", (land or "").strip().upper()
        if not n or not land:
            assert got[i].match_method == "missing_country_or_name"
            continue
        here = [x for x in rows if x[1] == land]
        if not here:
            assert got[i].match_method == "no_master_for_country"
            continue
        found = [x for x in here if letters(n) and letters(x[2]) == letters(n)]
        if len(found) < 3:
            more = here
            for t in sorted({t for t in re.findall("[a-z0-9]+", n) if len(t) >= 4 and t not in STOP_TOKENS}, key=lambda t: (-len(t), t))[:2]:
                more = [x for x in more if t in x[2]]
                if len(more) < 4:
                    break
            found = found + [x for x in more if x not in found]
        assert got[i].candidate_count == len(found), (n, land, got[i], found)
        best = sorted((-score(n, x[2]), x[0], x[3]) for x in found if x[2])[:2]
        how = "no_candidates" if not found else "too_many_candidates" if len(found) > 4 else "no_match" if not best else "fuzzy_blocked" if best[0][0] <= -92 else "below_threshold"
        assert got[i].match_method == how and got[i].needs_review == (how != "fuzzy_blocked")
        if how == "fuzzy_blocked":
            assert got[i].entity_id == best[0][2] and got[i].match_score == -best[0][0]
        if how == "below_threshold":
            assert [x.split("|")[0] for x in got[i].top_candidates.split("; ")] == [b[2] for b in best]
    by_name = {x.r_key: x for x in resolve.resolve_by_domain(r, m, "website", most=20, k=2).collect()}
    webs = {i: w or "" for i, _, _, _, w in master}
    for i, n, land, web in roster:
        n, land, web = n or "", (land or "").strip().upper(), {"http://www.a.es/x": "a.es"}.get(web, web or "")
        here = [x for x in rows if x[1] == land]
        same = [x for x in here if web and webs[x[0]] == web]
        pick = same if 1 < len(same) <= 20 else here
        best = sorted((-score(n, x[2]), x[0], x[3]) for x in pick if x[2] and n)[:2]
        high = bool(best) and best[0][0] <= -92
        if not n and not web:
            how = "empty"
        elif len(same) == 1:
            how = "domain_exact"
        elif 1 < len(same) <= 20:
            how = "domain+fuzzy" if high else "domain_ambiguous"
        else:
            how = "no_country_index" if not here or not n else "fuzzy_country" if high else "fuzzy_below_threshold"
        assert by_name[i].match_method == how, (i, n, land, web, by_name[i])
        if how in ("domain+fuzzy", "fuzzy_country"):
            assert by_name[i].entity_id == best[0][2]
    assert resolve.resolve_by_blocks(r.limit(0), m).count() == 0 and resolve.resolve_by_domain(r, m.limit(0), "website").count() == 65
    queue = resolve.review_by_blocks(blocks, 4)
    assert {x.r_key for x in queue.collect()} == {k for k, x in got.items() if x.match_method in ("too_many_candidates", "below_threshold")}


def test_exploded_runs_are_not_broadcast(spark):
    names = spark.sql("SELECT * FROM VALUES (1, 'Grupo Lupo Sol'), (2, 'Lup'), (3, 'lupo'), (4, NULL), (5, 'Sol AB') AS t(id, name)")  # of known size
    brands = spark.sql("SELECT * FROM VALUES (' LUPO '), ('ab'), (''), (NULL) AS t(brand)")
    hit = matching.contained(names, "id", "name", brands, "brand")
    plan = hit._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert {r.id for r in hit.collect()} == {1, 3, 5}


def test_blocks_of_names_are_not_broadcast(spark):
    asked = spark.sql("SELECT * FROM VALUES ('g', 'lupo sol'), ('g', ''), ('h', 'bredeli') AS t(group, normal)")
    known = spark.sql("SELECT * FROM VALUES ('g', 'lupo sal', 1L), ('g', 'zabro', 2L), ('x', 'bredeli', 3L) AS t(group, m_normal, first)")
    found = nearest.nearest(asked, known, 1, 80.0)
    assert "SortMergeJoin" in found._jdf.queryExecution().executedPlan().toString()
    assert [(r.normal, r.m_normal, r["first"]) for r in found.collect()] == [("lupo sol", "lupo sal", 1)]


def test_bounds_by_letters_lose_nothing(monkeypatch):
    rng = random.Random(7)
    words = ["lupo", "sol", "sal", "fundacion", "fundacio", "de", "brelebo", "mitos", "mtios", "a", "zabro", "pelir"]
    names = sorted({" ".join(rng.choices(words, k=rng.randint(1, 5))) for _ in range(300)} | {"x" * 70, "x" * 69 + "y"})
    block, counted = nearest.Block(names), []
    plain = nearest.Block.common
    monkeypatch.setattr(nearest.Block, "common", staticmethod(lambda encoded, query, held, at: counted.append(len(at)) or plain(encoded, query, held, at)))
    for cutoff in (60.0, 92.0):
        for q in names[::5]:
            want = sorted((round(weighted_ratio(q, t), 6) for t in names), reverse=True)[:3]
            assert [s for s, _ in block.best(q, 3, cutoff)][:3] == [s for s in want if s >= cutoff]
            assert all(round(weighted_ratio(q, names[i]), 6) == s for s, i in block.best(q, 3, cutoff))
    counted.clear()
    block.best("brelebo mitos", 1, 92.0)
    assert max(counted) < len(names) / 2


def test_resolved_rows_are_the_same_without_ranks_for_review(spark):
    master = spark.createDataFrame([(1, "e1", "lupo sol verde", "ES"), (2, "e2", "lupo sol verda", "ES"), (3, "e3", "zabro", "ES")], "row_id long, entity_id string, entity_name string, country string").withColumn("entity_name_norm", F.col("entity_name"))
    roster = spark.createDataFrame([(1, "Lupo sol verde", "ES"), (2, "lupo mitos pelir", "ES"), (3, None, "ES"), (4, "zabra", "ES")], "row_id long, raw_brand_name string, country_hint string").withColumn("website_hint", F.lit(""))
    whole, matched = ({r.r_key: (r.entity_id, r.needs_review) for r in resolve.resolve_by_blocks(roster, master, **o).collect()} for o in ({}, {"k": 1, "least": 92.0}))
    assert whole == matched and matched[1] == ("e1", False) and sum(not review for _, review in matched.values()) == 1


def test_many_candidates_are_all_met(spark):
    many = spark.range(200_001).selectExpr("id AS row_id", "concat('e', id) AS entity_id", "'lupobrelo zabro' AS entity_name_norm")
    one = spark.sql("SELECT 300000L AS row_id, 'f' AS entity_id, 'lupobrelo pelirzabrosit mitosbrelo sol' AS entity_name_norm")
    master = many.unionByName(one).withColumn("entity_name", F.col("entity_name_norm")).withColumn("country", F.lit("ES"))
    # the first by its letters, the second by a token, the third by the longer of two tokens, whose other is mistyped; the last meets the country
    roster = spark.createDataFrame([(1, "Lupobrelo zabro"), (2, "zabro lupobrelo"), (3, "sol pelirzabrosit mitosbrela lupobrelo"), (4, "sol")], "row_id long, raw_brand_name string").withColumn("country_hint", F.lit("ES")).withColumn("website_hint", F.lit(""))
    got = {x.r_key: x for x in resolve.resolve_by_blocks(roster, master, k=1).collect()}
    assert [(got[i].entity_id, got[i].match_method, got[i].candidate_count) for i in (1, 2)] == [("e0", "fuzzy_blocked", 200_002.0)] * 2
    assert got[3].entity_id == "f" and got[4].match_method == "below_threshold" and got[4].candidate_count == 200_002.0


def test_best_of_a_land_without_scoring_each_name(monkeypatch):
    rng = random.Random(5)
    words = ["lupo", "sol", "sal", "fundacion", "de", "brelebo", "mitos", "mtios", "a", "zabro", "pelir", "ñu"]
    names = sorted({" ".join(rng.choices(words, k=rng.randint(1, 5))) for _ in range(300)} | {"x" * 70, "x" * 69 + "y", "lupo  sol"})
    first = rng.sample(range(1000), len(names))
    block, called = nearest.Block(names, first), []
    for q in [*names[::7], "lupo  sal", "zzz", "x" * 65, "mitos brel"]:
        assert nearest.partial_ratios(q, names).tolist() == pytest.approx([partial_ratio(q, t) for t in names])
        ranked = sorted((-round(weighted_ratio(q, t), 6), first[i], i) for i, t in enumerate(names))
        assert block.best(q, 5, 0.0) == [(-s, i) for s, _, i in ranked[:5]]
    monkeypatch.setattr(nearest, "weighted_ratio", lambda a, b: called.append(b) or weighted_ratio(a, b))
    block.best("fundacion brelebu", 5, 0.0)
    assert len(called) < len(names) / 10
