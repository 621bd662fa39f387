import random

import numpy as np
import pytest

from entwine.llm import leaks, mixing, personal


def edit_distance_in(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        prev, row[0] = row[0], i
        for j, t in enumerate(text, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (p != t))
    return min(row)


def test_bit_parallel_distance():
    rng = random.Random(1)
    for _ in range(300):
        a, b = [rng.choice("abc") for _ in range(rng.randint(0, 12))], [rng.choice("abc") for _ in range(rng.randint(0, 20))]
        assert leaks.distance(a, b) == edit_distance_in(a, b)


def test_leaks(spark):
    rng = random.Random(2)
    vocabulary = [f"wort{i}" for i in range(3000)]
    items = [(i, " ".join(rng.sample(vocabulary, 60))) for i in range(20)]
    stock = "der verein dankt allen helfern und wünscht ein gutes neues jahr"
    docs, want = [], set()
    for d in range(120):
        words = stock.split() * 2 + [rng.choice(vocabulary) for _ in range(80)]
        if d < 60:
            item = rng.choice(items)
            own = item[1].split()
            share = (1.0, 0.7, 0.55, 0.3)[d % 4]
            part = own[: int(60 * share)] if d % 8 < 4 else own[-int(60 * share) :]
            if d % 3 == 0:
                del part[len(part) // 2]
            if d % 5 == 0:
                part = part[: len(part) // 2] + "ein ganz anderer satz steht hier".split() + part[len(part) // 2 :]
            words = words[:30] + [w.upper() if d % 2 else w for w in part] + words[30:]
            if share > 0.5:
                want.add((d, item[0]))
        docs.append((d, "  ".join(words) if d % 7 else "\n".join(words), "x"))
    docs += [(500, None, "x"), (501, "", "x"), (502, "wort1 " * 200_000, "x"), (0, docs[0][1], "x")]
    items += [(100, None), (101, ""), (102, stock)]
    corpus = spark.createDataFrame(docs, "doc_id long, text string, item_id string")
    found = {(r.doc_id, r.item_id) for r in leaks.leaks(corpus, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert {f for f in found if f[1] < 100} == want
    assert leaks.leaks(corpus, spark.createDataFrame([], "item_id long, text string")).count() == 0
    assert leaks.leaks(corpus.limit(0), spark.createDataFrame(items, "item_id long, text string")).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_water_filling(seed):
    rng = random.Random(seed)
    sources = [f"s{i}" for i in range(6)]
    weights = [rng.random() for _ in sources]
    targets = {s: (w / sum(weights), rng.randint(1, 4)) for s, w in zip(sources, weights)}
    tokens = {s: rng.choice([0, 10, 1000, 50_000]) for s in sources}
    uses = mixing.water_fill(targets, tokens)
    gives = {s: u * tokens[s] for s, u in uses.items()}
    assert all(u <= targets[s][1] + 1e-9 for s, u in uses.items()) and set(uses) == {s for s in sources if tokens[s]}
    free = [s for s, u in uses.items() if u < targets[s][1] - 1e-9]
    for a in free:  # those not clamped share what is left in proportion to their targets
        assert gives[a] / targets[a][0] == pytest.approx(gives[free[0]] / targets[free[0]][0])
    assert mixing.water_fill({}, tokens) == {} and mixing.water_fill(targets, {}) == {}


def test_mixture(spark):
    rng = random.Random(3)
    docs = [(i, rng.choice(["big"] * 6 + ["mid", "mid", "small", None, "other"]), "word " * rng.randint(5, 40), "clash") for i in range(900)]
    docs += [(2000, "big", None, "clash"), (2001, "big", "", "clash")]
    targets = spark.createDataFrame([("big", 0.5, 2), ("mid", 0.3, 3), ("small", 0.15, 2), ("absent", 0.05, 2)], "source string, target_share double, max_repeats int")
    df = spark.createDataFrame(docs, "doc_id long, source string, text string, copies string")
    chosen, shares = mixing.mix(df, targets)
    rows = chosen.collect()
    assert {r.doc_id: r.copies for r in rows} == {r.doc_id: r.copies for r in mixing.mix(df, targets)[0].collect()}
    most = {"big": 2, "mid": 3, "small": 2}
    assert all(1 <= r.copies <= most[r.source] for r in rows)
    report = {r.source: r for r in shares.collect()}
    assert report["absent"].actual_share == 0 and report["other"].used_tokens == 0 and report[None].used_tokens == 0
    uses = mixing.water_fill({"big": (0.5, 2), "mid": (0.3, 3), "small": (0.15, 2)}, {s: report[s].available_tokens for s in most})
    total = sum(u * report[s].available_tokens for s, u in uses.items())
    for s, u in uses.items():
        assert report[s].actual_share == pytest.approx(u * report[s].available_tokens / total, abs=0.01)


TEXTS = {
    "Contacto: María Zugre Pelón, tel. +34 790 746 668, maria.zugre@pelon.example.": {("person_name", "María Zugre Pelón"), ("phone", "+34 790 746 668"), ("email", "maria.zugre@pelon.example")},
    "Signé par M. Duchózu, Małgorzata, titulaire de la pièce 99287073-Y.": {("person_name", "Duchózu, Małgorzata"), ("id_number", "99287073-Y")},
    "Entidad promotora: Fundación Dolores Rubrogra. NIF de la entidad: B99304118.": set(),
    "Factura FA 452 512 940 abonada. El expediente lleva el número AR-48251/27.": set(),
    "É. Râsebro habite 125, bd Marena et répond à e.rasebro AT matru-web DOT test.": {("person_name", "É. Râsebro"), ("street_address", "125, bd Marena"), ("email", "e.rasebro AT matru-web DOT test")},
    "Se identificó José de Figava y Gobúr con documento X-9690798-R.": {("person_name", "José de Figava y Gobúr"), ("id_number", "X-9690798-R")},
    "Unos 3910 socios votaron el 14.7.2018.": set(),
    "Als Wohnanschrift ist Cordelstraße 95-A angegeben. Anrufen: +49-30-23125460": {("street_address", "Cordelstraße 95-A"), ("phone", "+49-30-23125460")},
    "": set(),
}


def test_personal_data(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(100, None, "x"), (101, "a " * 300_000 + "info@sol.example", "x"), (0, list(TEXTS)[0], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, pii_type string")
    found, texts = personal.scan(df)
    got = {}
    for r in found.collect():
        got.setdefault(r.doc_id, set()).add((r.pii_type, r.pii_value))
    for i, (t, want) in enumerate(TEXTS.items()):
        assert got.get(i, set()) == want, t
    assert got[101] == {("email", "info@sol.example")}
    masked = {r.doc_id: r.masked for r in texts.collect()}
    assert masked[0] == "Contacto: [PERSON_NAME_1], tel. [PHONE_1], [EMAIL_1]." and masked[100] is None and masked[2] == list(TEXTS)[2]
    assert personal.scan(df.limit(0))[0].count() == 0


def test_repetitions_agree():
    """A place without cue takes the label of its repetition, and equal evidence leaves a tie to the first label."""
    row = lambda **x: np.array([x.get(y, 0.0) for y in personal.LABELS])
    field = personal.Field({"strong": row(phone=3.0), "weak": row(O=0.2)}, np.zeros((len(personal.LABELS),) * 2), dict.fromkeys("ENSW", 2.0))
    nodes = [personal.Place("N", 0, 1, "123456789"), personal.Place("N", 5, 6, "123 456 789"), personal.Place("N", 8, 9, "987654321")]
    for node, feature in zip(nodes, ("strong", "weak", "weak")):
        node.features = [feature]
    assert field.label(nodes) == ["phone", "phone", "O"] and field.label(nodes, 0) == ["phone", "O", "O"] and field.label([]) == []


def test_messages_decide_on_whole_texts(spark):
    """On the documents themselves: labels come from the jointly trained weights, and where the cues before a place are taken away messages put right what unary scores get wrong."""
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("text IS NOT NULL").select("text").distinct()
    texts, common = sorted(r.text for r in rows.collect()), personal.common_words(rows)
    field = personal.train(texts[::2], common)
    bare = personal.Field(field.unary, field.chain, dict.fromkeys(field.skip, 0.0))
    assert field.skip["W"] > 0 and np.abs(field.chain).max() > 0.1
    wrong = dict.fromkeys(("field", "unary", "bare"), 0)
    changed = known = 0
    for text in texts[1::2]:
        nodes = personal.places(text, common)
        known += sum(p.silver is not None for p in nodes)
        for p in nodes:
            p.features, p.hidden = [f for f in p.features if ".w" not in f and ".org" not in f], []  # without cues from before the place
        labels = {"field": field.label(nodes), "unary": field.label(nodes, 0), "bare": bare.label(nodes)}
        changed += sum(a != b for a, b in zip(labels["field"], labels["unary"]))
        for how, found in labels.items():
            wrong[how] += sum(p.silver not in (None, y) for p, y in zip(nodes, found))
    assert changed > 0
    assert wrong["field"] < 0.2 * known and wrong["field"] <= wrong["bare"] and wrong["field"] < wrong["unary"], (wrong, known, changed)


def test_copied_leak_does_not_become_stock(spark):
    rng = random.Random(4)
    vocabulary = [f"wort{i}" for i in range(5000)]
    items = [(i, " ".join(rng.sample(vocabulary, 80))) for i in range(10)]
    half = items[0][1].split()[:44]
    base = rng.sample(vocabulary, 60)
    docs = []
    for d in range(400):
        if d < 130:  # near copies of one document, each with a word of its own
            words = base[:30] + half + base[30:]
            words[rng.randrange(30)] = f"eigen{d}"
        else:
            words = rng.sample(vocabulary, 100)
        docs.append((d, " ".join(words)))
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert {tuple(r)[:2] for r in leaks.leaks(*frames).collect()} == {(d, 0) for d in range(130)}


def test_every_chain_is_examined():
    rng = random.Random(5)
    item = [f"wort{i}" for i in range(80)]
    held = leaks.Items([(1, " ".join(item))], {w: 1.0 for w in item})
    text = []
    for _ in range(9):  # decoys: eight whole pieces each, with too many words between
        for at in range(0, 32, 4):
            text += item[at : at + 4] + [f"x{rng.randrange(10**9)}" for _ in range(4 if at % 8 else 3)]
    text += [f"z{i}" for i in range(30)]
    real = item[40:80]
    for at in (2, 6, 14, 18):  # within the edits, and fewer whole pieces than a decoy
        real[at] = f"y{at}"
    text += item[36:40] + real
    assert [k for k, _ in held.leaked(" ".join(text))] == [1]


def test_recurring_surname_is_found(spark):
    texts = [f"Contacto: María Zugre, expediente {i}. El servicio continúa sin cambios." if i % 3 else f"El servicio número {i} continúa. Servicio abierto. Firma: Zugre, Dolores." for i in range(60)]
    texts += [f"Texto {i} sobre otra cosa." for i in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {(r.doc_id, r.pii_value) for r in personal.scan(df)[0].collect() if r.pii_type == "person_name"}
    assert found == {(i, "María Zugre" if i % 3 else "Zugre, Dolores") for i in range(60)}
    common = personal.common_words(df.select("text"))
    assert {"servicio", "contacto", "expediente"} <= common and "zugre" not in common
