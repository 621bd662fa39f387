"""Records that differ in formatting only, collapsed and counted (problem 5).

The characters of a batch of texts pass through a lookup table that skips whatever is no letter or digit
and folds case, straight into rolling polynomial hashes of the words; the hashes of a record's words are
added up, so the order of words and fields does not matter and no canonical text is ever built. Letters that stand
alone make one word with those beside them ("S. L. U."). A second key rolls over the whole name as one word, so
blanks and signs inside words do not matter either, a third leaves letters alone as words of their own; groups that
share one of the keys are one. Rows whose
hashes collide are compared with the first row of their hash by two pointers that skip in the same way.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entwine.llm.components import components
from entwine.plans.durable import durable

#: Two independent 64-bit polynomials.
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
SIZE = 0x110000
#: Hashes that formatting does not change: by word or not, with letters alone glued or not.
KEYS = {"words": (True, True), "whole": (False, True), "single": (True, False)}
PAIR = T.StructType([T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType())])


@lru_cache(1)
def fold_table() -> np.ndarray:
    """For each code point its folded code point, or 0 to skip it."""
    table = np.zeros(SIZE, np.uint32)
    for point in range(SIZE):
        c = chr(point)
        if c.isalnum():
            low = c.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


@lru_cache(8)
def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    with np.errstate(over="ignore"):
        np.cumprod(np.full(n - 1, base, np.uint64), out=out[1:])
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words without visible structure."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def hashes(texts: list[str | None], by_word: bool = True, glue: bool = True) -> np.ndarray:
    """A (len(texts), 2) array of order-free hashes; with by_word False a text is one word, whatever blanks it holds; with glue False letters that stand alone stay words.

    Null and texts without letters or digits get 0.
    """
    return hashes_of(texts, [(by_word, glue)], BASES)[0]


def hashes_of(texts: list[str | None], ways: list[tuple[bool, bool]], bases: tuple[np.uint64, ...]) -> list[np.ndarray]:
    """hashes() for each of `ways` (by_word, glue) with a column for each of `bases`, the letters folded and mixed once for all."""
    clean = [tidy(x) for x in texts]
    n = np.fromiter(map(len, clean), np.int64, len(clean))
    out = [np.zeros((len(clean), len(bases)), np.uint64) for _ in ways]
    points = np.frombuffer("".join(clean).encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.repeat(np.arange(len(clean)), n)
    folded = fold_table()[points]
    kept = folded != 0
    symbols, rows = folded[kept].astype(np.uint64), row[kept]
    with np.errstate(over="ignore"):
        mixed = [mix(symbols + base) for base in bases]
    for sums, (by_word, glue) in zip(out, ways):
        if not len(symbols):
            break
        # a word starts at a kept character after a skipped one, or where another text starts; an apostrophe or dot skips, too
        if by_word:
            start = kept & np.concatenate([[True], ~kept[:-1] | (row[1:] != row[:-1])])
            if glue:  # a letter alone goes on with the word of the letter alone before it
                alone = start & np.concatenate([~kept[1:] | (row[1:] != row[:-1]), [True]])
                at = np.flatnonzero(start)
                glued = alone[at[1:]] & alone[at[:-1]] & (row[at[1:]] == row[at[:-1]])
                start[at[1:][glued]] = False
            starts = start[kept]
        else:
            starts = np.concatenate([[True], rows[1:] != rows[:-1]])
        first = np.flatnonzero(starts)
        length = np.diff(np.append(first, len(symbols)))
        place = np.arange(len(symbols)) - np.repeat(first, length)
        for k, base in enumerate(bases):
            with np.errstate(over="ignore"):
                terms = mixed[k] * powers(base, int(length.max()))[place]
                np.add.at(sums[:, k], rows[first], mix(np.add.reduceat(terms, first) + np.uint64(k + 1)))
    return [x.view(np.int64) for x in out]


def skip_equal(a: str, b: str) -> bool:
    """Two pointers that skip what the table skips."""
    table, i, j = fold_table(), 0, 0
    while True:
        while i < len(a) and not table[ord(a[i])]:
            i += 1
        while j < len(b) and not table[ord(b[j])]:
            j += 1
        if i == len(a) or j == len(b):
            return i == len(a) and j == len(b)
        if table[ord(a[i])] != table[ord(b[j])]:
            return False
        i, j = i + 1, j + 1


def spans(text: str, glue: bool = True) -> list[tuple[int, int]]:
    """Begin and end of each word; with glue, letters that stand alone side by side are one."""
    table, out, at, single = fold_table(), [], 0, False
    while at < len(text):
        if not table[ord(text[at])]:
            at += 1
            continue
        end = at
        while end < len(text) and table[ord(text[end])]:
            end += 1
        if glue and end - at == 1 and single:
            out[-1] = (out[-1][0], end)
        else:
            out.append((at, end))
        single, at = end - at == 1, end
    return out


def same_words(a: str, b: str, glue: bool = True) -> bool:
    """Whether two texts hold the same words in any order: each word is looked for among those of its length and first letter and compared by two pointers."""
    x, y = spans(a, glue), spans(b, glue)
    if len(x) != len(y):
        return False
    table = fold_table()
    kind = lambda t, i, j: (table[ord(t[i])], sum(1 for c in t[i:j] if table[ord(c)]))
    waiting: dict[tuple[int, int], list[str]] = {}
    for i, j in y:
        waiting.setdefault(kind(b, i, j), []).append(b[i:j])
    for i, j in x:
        left = waiting.get(kind(a, i, j), [])
        hit = next((k for k, w in enumerate(left) if skip_equal(a[i:j], w)), None)
        if hit is None:
            return False
        left.pop(hit)
    return True


def tidy(text: str | None) -> str:
    """Composed letters, and ß as ss, as hashes() takes them; most texts come back as they are."""
    text = text or ""
    if text.isascii():
        return text
    text = text if unicodedata.is_normalized("NFC", text) else unicodedata.normalize("NFC", text)
    return text.replace("ß", "ss").replace("ẞ", "ss")


def same_record(a: list, b: list) -> bool:
    """Whether two records hold the same letters and digits: the first field up to the order of words, the rest up to the order of fields."""
    a, b = [tidy(x) for x in a], [tidy(x) for x in b]
    if not (skip_equal(a[0], b[0]) or same_words(a[0], b[0]) or same_words(a[0], b[0], False)):
        return False
    left = b[1:]
    for x in a[1:]:
        hit = next((k for k, y in enumerate(left) if skip_equal(x, y)), None)
        if hit is None:
            return False
        left.pop(hit)
    return True


def record_hash(name: Column, *fields: Column, by_word: bool = True, glue: bool = True) -> Column:
    """h1, h2 of a record: `name` word by word (or as one word), each further field as one word, all added up."""

    @F.pandas_udf(PAIR)
    def hash_record(*columns: pd.Series) -> pd.DataFrame:
        total = hashes(list(columns[0]), by_word, glue).view(np.uint64).copy()
        with np.errstate(over="ignore"):
            for c in columns[1:]:
                total += mix(hashes(list(c), by_word=False).view(np.uint64) + np.uint64(5))
        out = total.view(np.int64)
        return pd.DataFrame({"h1": out[:, 0], "h2": out[:, 1]})

    return hash_record(name, *fields)


def name_hashes(name: Column) -> Column:
    """Struct of the h1 of record_hash() of `name` for each of KEYS, all from one pass."""

    @F.pandas_udf(T.StructType([T.StructField(h, T.LongType()) for h in KEYS]))
    def hash_names(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({h: x[:, 0] for h, x in zip(KEYS, hashes_of(list(texts), list(KEYS.values()), BASES[:1]))})

    return hash_names(name)


def differing(here: Column, first: Column) -> Column:
    """Null where a record equals the first of its hash, else its exact text: hashes that collide by chance are told apart."""

    @F.pandas_udf("string")
    def told_apart(here: pd.DataFrame, first: pd.DataFrame) -> pd.Series:
        return pd.Series([None if same_record(list(a), list(b)) else repr([tidy(x).lower() for x in a]) for a, b in zip(here.itertuples(index=False), first.itertuples(index=False))])

    return told_apart(here, first)


def count_copies(rows: DataFrame, key: str, name: str, *fields: str) -> DataFrame:
    """`key` of the first row (least key) of each set of two or more equal records, and `n_copies`.

    Rows whose name has no letter or digit, null names included, are no records. Equal rows are counted first,
    with partial sums on the map side, so a record with a third of all rows is one row per task. The different
    spellings are grouped by the hash of their words and verified; groups that share one of the other hashes are
    then joined by components of the few edges that leads to.
    """
    columns = (name, *fields)
    record = F.struct(*[F.col(c) for c in columns])
    spelled = rows.where(F.col(name).rlike(r"[\p{L}\p{N}]")).groupBy(*columns).agg(F.count("*").alias("n"), F.min(key).alias("k"))
    each = [record_hash(F.col(name), *[F.col(f) for f in fields], by_word=w, glue=g).alias(h) for h, (w, g) in KEYS.items()]
    hashed = durable(spelled.select("*", *each).select(record.alias("record"), "n", "k", *KEYS))

    def verified(here: DataFrame, several: str) -> DataFrame:
        """(k, set) of the spellings of `here` (record, k, h1, h2) that share a hash for which `several` holds: the least key of those that equal the first one."""
        size = here.groupBy("h1", "h2").agg(F.min_by("record", "k").alias("first"), F.expr(several).alias("_several")).where("_several").drop("_several")
        met = here.join(size, ["h1", "h2"]).withColumn("other", F.coalesce(differing(F.col("record"), F.col("first")), F.lit(""))).select("k", "h1", "h2", "other")
        return met.join(met.groupBy("h1", "h2", "other").agg(F.min("k").alias("set")), ["h1", "h2", "other"]).select("k", "set")

    by_words = verified(hashed.select("record", "k", "words.h1", "words.h2"), "count(*) > 1")
    homed = durable(hashed.drop("words").join(by_words, "k", "left").withColumn("set", F.coalesce("set", "k")))
    # a spelling belongs to its set of words; where another key holds several sets, it ties them together
    others = [verified(homed.select("record", "k", f"{h}.h1", f"{h}.h2", F.col("set").alias("home")), "min(home) <> max(home)") for h in ("whole", "single")]
    sets = homed.select("k", F.col("set").alias("a"))
    ends = others[0].unionByName(others[1]).join(sets, "k").join(sets.select(F.col("k").alias("set"), F.col("a").alias("b")), "set")
    edges = durable(ends.select("a", "b").where("a <> b").distinct())
    counted = homed.groupBy("set").agg(F.sum("n").alias("n"), F.min("k").alias("k"))
    if not edges.isEmpty():
        roots = components(edges)
        counted = counted.join(roots.withColumnRenamed("node", "set"), "set", "left").groupBy(F.coalesce("root", "set").alias("set")).agg(F.sum("n").alias("n"), F.min("k").alias("k"))
    return counted.where("n > 1").select(F.col("k").alias(key), F.col("n").alias("n_copies"))
