import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from entwine.functions import ids, similarity, text


def values(spark, column, rows, schema="x string"):
    return [r[0] for r in spark.createDataFrame(rows, schema).coalesce(1).select(column).collect()]


@pytest.mark.parametrize(
    ("column", "cases"),
    [
        (lambda x: text.name_for_matching(x), {"Acme SASU": "acme", "S.L.U. Acme": "u acme", "Musa S.A.": "musa s a", "A & B/C": "a b c", "Łódź Straße": "lodz strasse", None: "", "": ""}),
        (lambda x: text.name_for_resolving(x), {" Café-Bar & Söhne, (x) ": "café-bar & söhne x", None: ""}),
        (lambda x: text.name_for_register(x), {"Grupo Acme, S.L.": "acme", "Sociedad Cooperativa Sol": "sol", None: ""}),
        (lambda x: text.roster_key(x), {"GRUPO  Ilunion": "ilunion", "Group ILUNION": "ilunion", "Ilunion Sol": "ilunion sol"}),
        (lambda x: text.clean_text(x), {" a  b ": "a b", "nan": None, " ": None, None: None}),
        (lambda x: text.legal_form(x), {"Sol S.L.U.": "S.L.U.", "Sol s. coop": "S.COOP", "Sol": None, None: None}),
        (lambda x: ids.siren(x), {"123 456 789": "123456789", "12345678900017": "123456789", "1234": None, None: None}),
        (lambda x: ids.siren_of_sheet(x), {"123456789.0": "123456789", "12345": None}),
        (lambda x: ids.tax_es(x), {"B12345678": "B12345678", "CIF: B12345678": "", "ESB12345678": "", None: ""}),
        (lambda x: ids.domain(x), {"www.web.de": "web.de", "http://u@WWF.org:80/x": "wwf.org", None: "", "": ""}),
        (lambda x: ids.domain(x, True), {"www.web.de": "eb.de", "wwf.org": "f.org"}),
        (lambda x: text.is_commercial(x), {"Acme S.A.": True, "Acme gGmbH": False, "Les amis": False, "X Inc.": True, None: False}),
        (lambda x: text.too_generic(text.name_for_matching(x)), {"acme lyon": False, "lab eu": True, "acme": True, "solidaire": False, None: True}),
        (lambda x: text.is_brand(x), {"Grupo Ilunion SL": True, "ilunionx": False, None: False}),
    ],
)
def test_truth_table(spark, column, cases):
    assert values(spark, column(F.col("x")), [(k,) for k in cases]) == list(cases.values())


def test_name_rules(spark):
    cases = {("DE", "Foo eG"): "coop", ("FR", "X SCOP association"): "coop,marker", ("XX", "any"): "", ("FR", "SOCIÉTÉ COOPÉRATIVE X"): "coop", ("PT", "Foo C.R.L"): "coop", ("PT", "Foo C.R.L."): "", ("CZ", "x o.p.s"): "marker", ("CZ", "x o.p.s."): "", (None, None): ""}
    df = spark.createDataFrame(list(cases), "c string, n string").coalesce(1)
    assert [r[0] for r in df.select(F.array_join(text.triggers(F.col("c"), F.col("n")), ",")).collect()] == list(cases.values())


def test_tax_root(spark):
    cases = {("FR", "12345678900017"): "123456789", ("FR", "12"): None, ("IT", "  x "): "x", (None, "nan"): None, ("FR", None): None}
    df = spark.createDataFrame(list(cases), "c string, t string").coalesce(1)
    assert [r[0] for r in df.select(ids.tax_root(F.col("c"), F.col("t"))).collect()] == list(cases.values())


def test_scores():
    assert similarity.ratio("supplier 000000001", "supplier 000000002") == pytest.approx(94.444, abs=1e-3)
    assert similarity.token_set_ratio("acme solidaire lyon", "acme solidaire") == 100
    assert similarity.weighted_ratio("acme solidaire lyon", "acme solidaire") == 95
    assert similarity.weighted_ratio("", "x") == similarity.weighted_ratio(None, "x") == 0


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
        row = new
    return row[-1]


TEXT = st.text("abc d", max_size=14)


@given(TEXT, TEXT)
@settings(max_examples=300, deadline=None)
def test_scores_hold_their_bounds(a, b):
    assert similarity.common_length(a, b) == lcs(a, b)
    score = similarity.weighted_ratio(a, b)
    assert 0 <= score <= 100 and score == similarity.weighted_ratio(b, a)
    if a and b and max(len(a), len(b)) / min(len(a), len(b)) >= 1.5:
        assert score <= 90


def test_nearest_against_brute_force(spark):
    import random

    from entwine.operators.nearest import nearest

    rng = random.Random(5)
    pool = ["acme", "solidaire", "lyon", "taller", "norte", "sur", "verde", "limpieza", "ñandú", "x"]
    name = lambda: " ".join(rng.choice(pool)[: rng.randint(1, 9)] for _ in range(rng.randint(1, 5)))
    targets = [(g, name(), i) for i in range(300) for g in ("a", "b")] + [("a", "y" * 90, 900), ("a", "", 901), ("c", "lone", 902)]
    queries = [("a", name()) for _ in range(40)] + [("b", name()) for _ in range(10)] + [("a", "y" * 88 + "z"), ("c", "lone"), ("a", ""), ("none", "acme")]
    q, t = spark.createDataFrame(queries, "group string, normal string"), spark.createDataFrame(targets, "group string, m_normal string, first long")
    for k, cutoff in ((1, 92.0), (5, 0.0)):
        got: dict = {}
        for r in nearest(q, t, k, cutoff).collect():
            got.setdefault((r.group, r.normal), []).append((-r.score, r["first"]))
        for g, n in set(queries):
            least: dict = {}
            for h, m, i in targets:
                if h == g and m and n:
                    least[m] = min(i, least.get(m, i))
            want = sorted((-round(similarity.weighted_ratio(n, m), 6), i) for m, i in least.items())
            assert sorted(got.get((g, n), [])) == [w for w in want if -w[0] >= cutoff][:k], (g, n)
    assert nearest(q.limit(0), t).count() == 0 and nearest(q, t.limit(0)).count() == 0
