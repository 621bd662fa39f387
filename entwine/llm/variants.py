"""Variant spellings of names, linked (problem 4).

The distinctive words of each name make one string per order of the words. A string within k edits of another
shares with it at least one of k+1 segments at nearly the same place, so an inverted index over (country,
length, segment number, segment) finds every pair; banded edit distance verifies. Names abbreviated to an
initial are found in the same index under their first word and initial. Links make components; each is an entity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entwine.llm.components import components
from entwine.llm.names import with_line
from entwine.plans.durable import durable, shuffled

#: Land of names whose country nothing tells.
NOWHERE = "??"
#: Edits allowed by the letters of the shorter string: for names in full, and for a word with an initial or a given name.
ALLOWED = {"full": "CASE WHEN {n} >= 9 THEN 2 WHEN {n} >= 5 THEN 1 ELSE 0 END", "short": "CASE WHEN {n} >= 8 THEN 2 WHEN {n} >= 6 THEN 1 ELSE 0 END"}

#: Letters that tell strings apart before their edits are counted, and those that do so when they stand twice.
SIGNED, TWICE = "abcdefghijlmnopqrstuvz", "aeiou"
#: Bits for what tells strings apart, beside which 26 bits of a key stay.
SIGNS = 38


def texts_of(side: str, few: bool) -> Column:
    """The strings that stand for a form (core, initial, given) on one side of the index, as array of (kind, p, r).

    full: all words in any order. Two words stand in the index in both orders. Of more words two hold all edits in
    some pair of orders, so each choice of two (r) is keyed together with the others as they are (p); the words of
    such a name also stand joined, in each rotation, for names in which a blank was typed or lost.
    short: a word with the initial of the other. person: a surname with the given name, where the form names two
    surnames or that one only.
    few: for forms of one or two words, which most are; compiled, with null for strings that a form does not have.
    Else for forms of more, which have no initial and no kind but full.
    """
    core, initial, given = map(F.col, ("core", "initial", "given"))
    w, n, both = F.split(core, " "), F.size(F.split(core, " ")), side == "index"
    entry = lambda kind, p, r: F.struct(F.lit(kind).alias("kind"), p.alias("p"), r.alias("r"))
    full = lambda r: entry("full", F.lit(""), r)
    if few:
        one, two = F.substring_index(core, " ", 1), F.when(core.contains(" "), F.substring_index(core, " ", -1))
        found = [full(F.when(two.isNotNull(), F.concat(one, two)).when(initial.isNull(), one)), entry("short", F.lit(""), F.when(two.isNull(), F.concat(one, initial)))]
        if both:
            found += [full(F.concat(two, one)), entry("short", F.lit(""), F.concat(one, F.left(two, F.lit(1)))), entry("short", F.lit(""), F.concat(two, F.left(one, F.lit(1))))]
        return F.array(*found, entry("person", F.lit(""), F.when((two == given) == F.lit(not both), F.concat(one, given))))
    orders = lambda p, a, b: F.array(entry("full", p, F.concat(a, b)), *([entry("full", p, F.concat(b, a))] if both else []))
    rest = lambda i, j: F.array_join(F.array_sort(F.filter(w, lambda x, k: (k != i) & (k != j))), "_")
    chosen = F.flatten(F.flatten(F.transform(F.sequence(F.lit(0), n - 2), lambda i: F.transform(F.sequence(i + 1, n - 1), lambda j: orders(rest(i, j), w[i], w[j])))))
    turned = lambda i: full(F.array_join(F.concat(F.slice(w, i + 1, n - i), F.slice(w, F.lit(1), i)), ""))
    return F.concat(F.transform(F.sequence(F.lit(0), n - 1), turned) if both else F.array(turned(F.lit(0))), chosen)


def segment_keys(forms: DataFrame, side: str) -> DataFrame:
    """`forms` with kind, text, sig and h in place of core, initial and given: a row for each key of the segment index, all native.

    A string of n letters with k edits is cut into k+1 segments as even as possible, the longer ones last. Index:
    its own segments. Probe: for each length that k edits allow, the substrings at the places to which i edits
    before and k-i after can shift segment i. Edits go by the shorter string of a pair, for `full` always the one
    in the index. An initial, and the last letter of a given name, is never edited, so it is in every key. `sig` has a
    bit for each letter of SIGNED that r holds, and for those of TWICE that it holds again: an edit changes two at most.
    """
    kept = [c for c in forms.columns if c not in ("core", "initial", "given", "in")]
    text = F.concat(F.left("t.kind", F.lit(1)), F.when(F.col("t.p") != "", F.concat("t.p", F.lit("|"))).otherwise(""), "t.r")
    many = F.col("core").like("% % %")
    said = forms.where(~many).withColumn("t", F.explode(texts_of(side, True))).where("t.r IS NOT NULL").unionByName(forms.where(many).withColumn("t", F.explode(texts_of(side, False))))
    each = said.select(*kept, "t.kind", "t.r", text.alias("text"), F.xxhash64("t.kind", "in", "t.p", F.when(F.col("t.kind") != "full", F.right("t.r", F.lit(1)))).alias("base"), F.length(F.replace("t.p", F.lit("_"), F.lit(""))).alias("m"))
    each = each.withColumn("n", F.length("r")).withColumn("sig", F.expr(" + ".join([f"IF(contains(r, '{c}'), {1 << i}L, 0L)" for i, c in enumerate(SIGNED)] + [f"IF(substring_index(r, '{c}', 2) <> r, {1 << i}L, 0L)" for i, c in enumerate(TWICE, len(SIGNED))])))
    allowed = lambda n: f"IF(kind = 'full', {ALLOWED['full'].format(n=f'({n} + m)')}, {ALLOWED['short'].format(n=n)})"

    # a row for each (k, segment i, letters by which the string looked for is shorter, shift); one small expression keys them all, so it is compiled; strings of kinds other than full that are two letters apart are no pair
    every = [(k, i, longer, shift) for k in (0, 1, 2) for longer in ((0,) if side == "index" else (0, 1, 2, -1)) if abs(longer) <= k for i in range(k + 1) for shift in ((0,) if side == "index" else range(max(-i, longer - (k - i)), min(i, longer + k - i) + 1))]
    ways = "explode(array(" + ", ".join("named_struct('k', {}, 'i', {}, 'longer', {}, 'shift', {})".format(*x) for x in every) + "))"
    cut = each.withColumn("w", F.expr(ways)).select(*kept, "kind", "text", "sig", "base", "r", "n", "m", "w.*").withColumn("long", F.expr("n - longer")).where("long >= 0 AND (longer = 0 OR long > 0) AND IF(kind = 'full', longer >= 0, longer < 2)").where(f"k = {allowed('long')}")
    own, left = "CAST(long DIV (k + 1) AS INT)", "long % (k + 1)"  # so many segments, the last ones, have a letter more
    size, at = f"{own} + IF({left} >= k + 1 - i, 1, 0)", f"i * {own} + greatest(0, {left} - (k + 1 - i)) + shift"
    placed = cut.withColumn("size", F.expr(size)).withColumn("at_", F.expr(at)).where("at_ >= 0 AND at_ + size <= n")
    return placed.select(*kept, "kind", "text", "sig", F.expr("xxhash64(base, long * 4 + i, substring(r, at_ + 1, size))").alias("h"))


def forms_of(rows: DataFrame, places: frozenset[str]) -> tuple[DataFrame, DataFrame]:
    """(key columns with `form`, forms). rows: key columns, then `name` and `land` (null where unknown).

    A form is a set of distinctive words, an initial and a land; its words, acts and lands are texts of words with
    single blanks. Rows whose name has no distinctive word get no form. A null land becomes the only land in whose
    names the general words are usual, or NOWHERE.
    """
    keys = [c for c in rows.columns if c not in ("name", "land")]
    parts = F.split("line", "\t")
    text = lambda i: F.when(parts[i] != "", parts[i])
    said = with_line(rows.where(F.col("name").isNotNull()), "name", places).where("line NOT LIKE '\t%'").select(
        *keys, F.coalesce("land", F.when((parts[4] != "") & ~parts[4].contains(" "), parts[4]), F.lit(NOWHERE)).alias("land"), parts[0].alias("core"), F.when(~parts[0].contains(" "), text(1)).alias("initial"), text(2).alias("given"), parts[3].alias("acts"), parts[4].alias("lands")
    )
    label = F.concat_ws("|", "land", F.array_join(F.sort_array(F.split("core", " ")), " "), F.coalesce("initial", F.lit("")))
    known = durable(said.withColumn("form", F.xxhash64(label)))
    forms = known.groupBy("form").agg(F.first("land").alias("land"), F.min("core").alias("core"), F.first("initial").alias("initial"), F.min("given").alias("given"), *[F.array_join(F.collect_set(c), " ").alias(c) for c in ("acts", "lands")])
    return known.select(*keys, "form"), forms


def words(name: str) -> Column:
    """The distinct words of a text of words."""
    return F.array_distinct(F.filter(F.split(name, " "), lambda x: x != ""))


def verified(s: Column, t: Column) -> Column:
    """Edits between two texts of segment_keys(), null if they are too many, or of different kinds."""
    letters = lambda x: F.length(F.translate(x, "|_", "")) - 1
    least, apart, kind = F.least(letters(s), letters(t)), F.levenshtein(s, t, 2), F.left(s, F.lit(1))
    full = F.when(least >= 9, 2).when(least >= 5, 1).otherwise(0)
    short = F.when(least >= 8, 2).when(least >= 6, 1).otherwise(0)
    swapped = F.sort_array(F.split(s, "")) == F.sort_array(F.split(t, ""))
    fair = F.when(kind == "f", apart <= full).otherwise((apart <= short) & (F.right(s, F.lit(1)) == F.right(t, F.lit(1))) & ((apart < 2) | swapped))
    return F.when((apart >= 0) & (kind == F.left(t, F.lit(1))) & fair, apart)


def close_pairs(forms: DataFrame, lands: list[str], keyed=segment_keys) -> DataFrame:
    """(kind, a, b, at, bits): forms a (probe) and b (index) of one land whose strings are within the edits allowed.

    kind is f for names in full, s for a word with an initial, p for a surname with a given name. A form without land
    probes every land in which its general words are usual, else every land there is; `at` is the land where it was
    found, null for forms that have one. Short keys and ids keep the rows of the join small.
    """
    every = F.array(*[F.lit(x) for x in lands])
    free = F.col("land") == NOWHERE
    usual = words("lands")
    where = F.when(free, F.array_append(F.when(F.size(usual) > 0, F.array_intersect(usual, every)).otherwise(every), F.lit(NOWHERE))).otherwise(F.array("land"))
    columns = ["core", "initial", "given"]
    probes = forms.withColumn("in", F.explode(where)).select(F.col("id").alias("a"), *columns, "in", F.when(free, F.col("in")).alias("at"), (free | (F.size(F.split("core", " ")) > 2)).alias("open"))
    orders = keyed is not segment_keys  # texts of other keys hold all orders of the words, with blanks between
    left, right = keyed(probes, "probe"), keyed(forms.select(F.col("id").alias("b"), *columns, F.col("land").alias("in")), "index")
    # 26 bits of the key, and those of the letters, by which most candidates fall away before edits are counted
    packed = lambda side: F.expr(f"h << {SIGNS} | sig").alias(side)
    left = left.select(packed("x"), "a", "at", "open", F.col("text").alias("s"))
    right = right.select(packed("y"), "b", F.col("text").alias("t"))
    near = shuffled(left).join(shuffled(right), F.expr(f"x >> {SIGNS} = y >> {SIGNS}"))
    s, t = F.col("s"), F.col("t")
    bits = F.when(~t.contains(" "), verified(s, t)).otherwise(F.array_min(F.transform(F.split(t, " "), lambda x: verified(s, x)))) if orders else verified(s, t)
    # as a case, as Spark counts edits that stand twice before it looks at anything else; the rest of the test waits for the few pairs left
    close = "levenshtein(s, substring_index(t, ' ', 1), 2) >= 0 OR levenshtein(s, substring_index(t, ' ', -1), 2) >= 0 OR t LIKE '% % %'" if orders else "levenshtein(s, t, 2) >= 0"
    # where each side has all orders, strings of one length find each other twice; else either side may be the one that finds, as a blank can move
    once = "a <> b AND (open OR a < b OR length(s) <> length(t) OR left(s, 1) <> 'f')" if orders else "a <> b"
    # an edit changes two bits at most, and one only if it makes a string longer or shorter; under eight letters one edit is allowed at most
    other = "length(substring_index(t, ' ', 1))" if orders else "length(t)"
    far = f"bit_count(x ^ y) + abs(length(s) - {other}) > IF(least(length(s), {other}) < 9, 2, 4)"
    near = near.where(f"CASE WHEN bit_count(x ^ y) > 4 THEN false WHEN {far} THEN false WHEN {once} THEN {close} ELSE false END")
    return near.select(F.left("s", F.lit(1)).alias("kind"), "a", "b", "at", bits.alias("bits")).groupBy("kind", "a", "b", "at").agg(F.min("bits").alias("bits")).where("bits IS NOT NULL")


def entities(rows: DataFrame, places: frozenset[str], keyed=segment_keys) -> DataFrame:
    """The key columns of `rows` with `entity`, equal for the rows whose names are spellings of one name in one land.

    rows: key columns, then `name` and `land`. Rows without a distinctive word give no row. keyed: what finds
    the candidates, by default the segment index; every candidate is verified in the same way.
    """
    known, forms = forms_of(rows, places)
    forms = durable(forms.withColumn("id", F.monotonically_increasing_id()))  # short ids cost less to shuffle than hashes
    lands = sorted(r[0] for r in forms.select("land").distinct().collect() if r[0] != NOWHERE)  # countries: at most some 250
    pairs = durable(close_pairs(forms, lands, keyed))
    full = pairs.where("kind = 'f'")
    fixed = full.where(F.col("at").isNull() | (F.col("at") == NOWHERE))
    # a form without land goes with the land of its nearest forms, if that is one
    loose = full.where(F.col("at") != NOWHERE)
    nearest = loose.groupBy("a").agg(F.min("bits").alias("bits"))
    settled = loose.join(nearest, ["a", "bits"])
    settled = settled.join(settled.groupBy("a").agg(F.count_distinct("at").alias("n")).where("n = 1"), "a", "left_semi")
    roots = components(fixed.select("a", "b").unionByName(settled.select("a", "b")))
    rooted = forms.select("form", "id", "initial", words("acts").alias("acts")).join(roots, F.col("id") == F.col("node"), "left").select("form", "id", "initial", "acts", F.coalesce("root", "id").alias("entity"))
    # abbreviated forms join the entity that is nearest, if that is one; with a full form whose activity differs they have nothing to do
    a, b = rooted.select(F.col("id").alias("a"), F.col("acts").alias("acts_a")), rooted.select(F.col("id").alias("b"), F.col("acts").alias("acts_b"), "entity", F.col("initial").alias("ib"))
    short = pairs.where("kind <> 'f'").select("a", "b", "bits").join(a, "a").join(b, "b")
    alike = F.exists("acts_a", lambda x: F.exists("acts_b", lambda y: x.startswith(y) | y.startswith(x)))
    apart = (F.size("acts_a") > 0) & (F.size("acts_b") > 0) & ~alike
    # the same activity named counts more than none on one side
    ranked = short.where(~apart).select("a", "entity", (F.col("bits") * 2 + F.when(alike, 0).otherwise(1) + F.when(F.col("ib").isNull(), 0).otherwise(100)).alias("rank"))
    each = ranked.groupBy("a", "entity").agg(F.min("rank").alias("rank")).groupBy("a", "rank").agg(F.count("*").alias("n"), F.min("entity").alias("to"))
    chosen = each.groupBy("a").agg(F.min_by(F.struct("n", "to"), "rank").alias("x")).where("x.n = 1").select(F.col("a").alias("id"), "x.to")
    final = rooted.select("form", "id", "entity").join(chosen, "id", "left").select("form", F.coalesce("to", "entity").alias("entity"))
    return known.join(final, "form").drop("form")


def variant_pairs(rows: DataFrame) -> DataFrame:
    """(row_id_a, row_id_b), a < b: rows of one `entity` whose names differ in letters or digits.

    rows: row_id, entity, and hashes of the name that formatting does not change; names with one of them equal are
    no pair. The pairs are the result, so their number is not bounded by the rows.
    """
    hashes = [c for c in rows.columns if c not in ("row_id", "entity")]
    a, b = (rows.select("entity", F.col("row_id").alias(f"row_id_{s}"), *[F.col(c).alias(f"{c}_{s}") for c in hashes]) for s in "ab")
    differ = " AND ".join(["row_id_a < row_id_b", *[f"{c}_a <> {c}_b" for c in hashes]])
    return a.join(b, "entity").where(differ).select("row_id_a", "row_id_b")
