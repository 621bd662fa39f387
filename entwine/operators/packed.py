"""Several values packed in one field, unpacked by the dialect of least description length (problem 2).

A dialect says which delimiters separate values and whether quotes enclose them. Every distinct field text is
parsed in all dialects that its characters allow. A value costs the bits of its words under a model of word
pairs with begin and end, counted over the whole table; a parse costs its values and its dialect. The counts
start from texts whose dialect is beyond doubt and are then taken again from the cheapest parse of every text.
"""

from __future__ import annotations

import re
from itertools import combinations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entwine.plans.durable import durable

#: Delimiters that values hardly ever contain, and such as often stand inside values; patterns match between values.
STRONG = {"tab": r"\t", "line": r"\r?\n", "semi": ";", "pipe": r"\|", "bullet": r"(?:^|\s*)[•▪◦](?=\s)", "number": r"(?:^|(?<=\s))\(?\d{1,3}[.)]\s", "dot": r"\s·\s"}
WEAK = {"comma": ",", "slash": r"\s/\s", "dash": r"\s[-–—]\s", "tight": r"(?<=\w)/(?=\w)", "and": r"\s&\s"}
ALL = STRONG | WEAK
#: Bits: a delimiter of the dialect (strong, weak), quotes, another value, a word never seen per letter, and smoothing of word pairs.
STRONG_BITS, WEAK_BITS, QUOTE_BITS, VALUE_BITS, LETTER_BITS, SMOOTH = 1.0, 2.0, 1.0, 1.0, 4.5, 2.0
QUOTED = re.compile(r'"(?:[^"]|"")*"')
MARK = re.compile(r"^\s*(?:[*•▪◦·–—-]\s+|\(?\d{1,3}[.)]\s+)")


def clean(item: str) -> str:
    """A value without blanks, list marks and enclosing quotes around it; doubled quotes inside become single ones."""
    item = MARK.sub("", item.strip()).strip()
    if len(item) >= 2 and item[0] == item[-1] == '"':
        item = item[1:-1].replace('""', '"').strip()
    elif len(item) >= 2 and (item[0], item[-1]) in (("'", "'"), ("“", "”"), ("«", "»"), ("„", "“")):
        item = item[1:-1].strip()
    return item


def split_values(text: str, delimiters: tuple[str, ...], quotes: bool) -> list[str]:
    """The values of a text in one dialect; empty ones do not count."""
    body = text.strip()
    if quotes and len(body) >= 2 and body[0] == "[" and body[-1] == "]":
        body = body[1:-1]
    held: list[str] = []

    def hide(m: re.Match) -> str:
        held.append(m[0])
        return f"\x02{len(held) - 1}\x03"

    if quotes:
        body = QUOTED.sub(hide, body)
    if not delimiters:
        parts = [body]
    else:
        parts = re.split("|".join(f"(?:{ALL[d]})" for d in delimiters), body)
    shown = (re.sub("\x02(\\d+)\x03", lambda m: held[int(m[1])], p) for p in parts) if held else parts
    return [v for v in map(clean, shown) if v]


def dialects(text: str) -> list[tuple[tuple[str, ...], bool]]:
    """Dialects that cut the text differently, the plainest of each cut first."""
    quotes = bool(QUOTED.search(text))
    outside = QUOTED.sub("", text) if quotes else text
    there = [d for d in ALL if re.search(ALL[d], outside)]
    out, seen = [], set()
    for n in range(len(there) + 1):
        for some in combinations(there, n):
            for q in (True, False) if quotes else (False,):
                values = tuple(split_values(text, some, q))
                if values and values not in seen:
                    seen.add(values)
                    out.append((some, q))
    return out


def words(value: str) -> list[str]:
    return [w.lower() for w in re.findall(r"\w+|[^\w\s]", value)]


def cost_of(delimiters: tuple[str, ...], quotes: bool, n: int) -> float:
    return sum(STRONG_BITS if d in STRONG else WEAK_BITS for d in delimiters) + QUOTE_BITS * (not quotes) + VALUE_BITS * n


def candidates(fields: DataFrame) -> DataFrame:
    """field_name, text, n (rows with it) and parses: array of values, bits of the dialect, sure (dialect beyond doubt)."""

    @F.pandas_udf("array<struct<vals:array<string>,bits:double,sure:boolean>>")
    def parses(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            quotes = bool(QUOTED.search(text))
            outside = QUOTED.sub("", text) if quotes else text
            strong = tuple(d for d in STRONG if re.search(STRONG[d], outside))
            weak = [d for d in WEAK if re.search(WEAK[d], outside) and d != "and"]
            sure = split_values(text, strong, quotes) if strong or not weak else split_values(text, ("comma",), True) if quotes and '",' in text.replace(" ", "") else None
            found = [(split_values(text, d, q), cost_of(d, quotes and q or not quotes, 0), d) for d, q in dialects(text)]
            out.append([{"vals": v, "bits": b + VALUE_BITS * len(v), "sure": v == sure} for v, b, _ in found])
        return pd.Series(out)

    distinct = fields.groupBy("field_name", "text").agg(F.count("*").alias("n"))
    return distinct.withColumn("parses", parses("text"))


def context(before: str, word: str) -> str:
    """What the next word depends on: the word, with the sign before it if there is one ("& Sons" ends a name, "Sons" need not)."""
    return f"{before} {word}" if before and not before.isalnum() else word


def pairs_of(parses: DataFrame) -> DataFrame:
    """The word pairs of the values of each parse: its columns, w1 (in its context), w2; "" is begin and end."""

    @F.pandas_udf("array<struct<w1:string,w2:string>>")
    def pairs(values: pd.Series) -> pd.Series:
        return pd.Series([[{"w1": context(o, a), "w2": b} for v in vs for ws in [["", "", *words(v), ""]] for o, a, b in zip(ws, ws[1:], ws[2:])] for vs in values])

    return parses.withColumn("p", F.explode(pairs("vals"))).select(*[c for c in parses.columns if c != "vals"], "p.w1", "p.w2")


def choose(parses: DataFrame, model: DataFrame, own: DataFrame | None) -> DataFrame:
    """The cheapest parse of each text under the word pairs of the texts in `model`.

    own: pairs that a text itself gave to the model; they are taken out before it is weighed, so no text
    confirms its own parse.
    """
    two = model.groupBy("field_name", "w1", "w2").agg(F.sum("n").alias("c12"))
    one = two.groupBy("field_name", "w1").agg(F.sum("c12").alias("c1"))
    last = two.groupBy("field_name", F.col("w2").alias("w")).agg(F.sum("c12").alias("c2"))
    total = last.groupBy("field_name").agg(F.sum("c2").alias("total"), F.count("*").alias("kinds"))  # one row per field
    every = pairs_of(parses.select("field_name", "id", "k", "bits", "vals", "n")).groupBy("field_name", "id", "k", "bits", "n", "w1", "w2").agg(F.count("*").alias("times"))
    joined = every.join(two, ["field_name", "w1", "w2"], "left").join(one, ["field_name", "w1"], "left").join(last.withColumnRenamed("w", "w2"), ["field_name", "w2"], "left").join(F.broadcast(total), "field_name", "left")
    if own is not None:
        mine12 = own.groupBy("field_name", "id", "w1", "w2").agg(F.sum("n").alias("o12"))
        mine1 = own.groupBy("field_name", "id", "w1").agg(F.sum("n").alias("o1"))
        joined = joined.join(mine12, ["field_name", "id", "w1", "w2"], "left").join(mine1, ["field_name", "id", "w1"], "left")
    else:
        joined = joined.withColumn("o12", F.lit(0)).withColumn("o1", F.lit(0))
    c = lambda x, o: F.greatest(F.lit(0.0), F.coalesce(x, F.lit(0)) - F.coalesce(o, F.lit(0)))
    single = F.when(F.coalesce("c2", F.lit(0)) > F.coalesce("o12", F.lit(0)), c(F.col("c2"), F.col("o12")) / (F.col("total") + 1.0)).otherwise(F.pow(F.lit(2.0), -LETTER_BITS * F.greatest(F.lit(1), F.length("w2"))) / (F.coalesce("total", F.lit(0)) + 1.0))
    chance = (c(F.col("c12"), F.col("o12")) + SMOOTH * single) / (c(F.col("c1"), F.col("o1")) + SMOOTH)
    bits = -F.log2(F.greatest(chance, F.lit(1e-300)))
    costs = joined.groupBy("field_name", "id", "k", "bits").agg(F.sum(bits * F.col("times")).alias("words"))
    return costs.groupBy("field_name", "id").agg(F.min_by("k", F.struct(F.round(F.col("bits") + F.col("words"), 6), F.col("k"))).alias("k"))


def unpack(rows: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """key, field_name, pos, item: the values of each field that holds at least two, in the order of the text.

    Null and blank fields, and fields with one value, give no row. Repeated values count each; repeated rows
    give their rows each. The work goes by distinct texts, so a text of a third of all rows is parsed once.
    """
    each = rows.select(key, F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).cast("string").alias("text")) for f in fields])).alias("f")).select(key, "f.*").where("text IS NOT NULL AND text RLIKE '\\\\S'")
    found = candidates(each.select("field_name", "text")).withColumn("id", F.xxhash64("field_name", "text"))
    parses = durable(found.select("field_name", "id", "n", F.posexplode("parses").alias("k", "p")).select("field_name", "id", "n", "k", "p.vals", "p.bits", "p.sure"))
    model = pairs_of(parses.where("sure").select("field_name", "id", "n", "vals"))
    several = parses.join(parses.groupBy("id").agg(F.count("*").alias("of")).where("of > 1").select("id"), "id", "left_semi")
    first = durable(choose(several, model, model))
    best = parses.join(parses.groupBy("id").agg(F.count("*").alias("of")), "id").join(first.select("id", F.col("k").alias("best")), "id", "left").where("of = 1 OR k = best")
    again = pairs_of(best.select("field_name", "id", "n", "vals"))
    second = choose(several, again, again)
    final = parses.join(parses.groupBy("id").agg(F.count("*").alias("of")), "id").join(second.select("id", F.col("k").alias("best")), "id", "left").where("(of = 1 OR k = best) AND size(vals) > 1")
    out = each.withColumn("id", F.xxhash64("field_name", "text")).join(final.select("id", "vals"), "id")
    return out.select(key, "field_name", F.posexplode("vals").alias("pos", "item")).select(key, "field_name", (F.col("pos") + 1).cast("int").alias("pos"), "item")
