"""Names decoded with the wrong character encoding: found and restored (problem 3).

A noisy channel: the true name was written in one encoding and read in another, whole or in part, once
or twice. For each word of a suspect name a lattice over its bytes holds every reading of every span;
lost bytes (U+FFFD) are wildcards: up to three in a row stand for any one letter. The words that the lattice
yields are weighed with the word frequencies of all undamaged names, and a Viterbi search over the words
of the name picks the reading with the least cost, where changing the encoding within a name costs too.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import pairwise
from math import log2

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entwine.plans.durable import spread

#: Encodings in which UTF-8 bytes may have been read.
MULTI = ("cp1252", "latin-1", "cp850", "cp437", "mac_roman", "cp1250")
#: Pairs (written in, read in) of single-byte encodings.
SINGLE = (("cp1250", "cp1252"), ("iso8859_2", "latin-1"))
#: Letters and signs that names in the languages of the registers use beyond ASCII.
LETTERS = "àáâãäåæçèéêëìíîïñòóôõöøùúûüýÿœßąćęłńóśźżčřšžěůďťňőűă" + "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝŒĄĆĘŁŃŚŹŻČŘŠŽĚŮĎŤŇŐŰĂ"
SIGNS = "«»“”‘’„–—…ºª°·€&"
LOST = "�"
#: The no-break space that belongs to a garbled letter, typed over with a plain blank.
BLANKED = r"(?<=[a-z][a-z])\xC3 (?=[a-z]|[A-Z][a-z])|(?<= [A-Z])\xC3 (?=[a-z])|(?<=^[A-Z])\xC3 (?=[a-z])"
#: Signs that no name contains and that a single-byte mix-up makes of a letter.
ODD = "¹³¿£¯¥¼¶±¦"
#: Letters that a single-byte mix-up makes of Polish ones, though other languages use them.
FOREIGN = "êæñœÊÆÑŒŸ"
#: Readings of a word that are kept, and rounds of wrong decoding that are undone.
BEAM, ROUNDS = 12, 3
#: Bits for: a change of encoding inside a name, an unseen word, an unseen word's odd letter, each round.
SWITCH, UNSEEN, ODD_BITS, ROUND_BITS = 4.0, 22.0, 9.0, 0.5
#: Holes of a word in which letters are tried, all with all; bits of a letter in one of them.
HOLES, WILD_BITS = 2, log2(len(LETTERS) / 2)

READING = T.StructType([T.StructField("pos", T.IntegerType()), T.StructField("word", T.StringType()), T.StructField("codec", T.StringType()), T.StructField("bits", T.DoubleType())])


@lru_cache(1)
def spans() -> dict[str, dict[str, str]]:
    """For each encoding: the garbled form of each letter and sign."""
    out: dict[str, dict[str, str]] = {}
    between = sorted({bytes([b]).decode(codec, "ignore") or chr(b) for codec in MULTI for b in range(128, 256)})  # after one of two wrong decodings
    for codec in MULTI:
        table = {}
        for c in dict.fromkeys([*LETTERS, *SIGNS, *between]):
            raw = c.encode("utf-8")
            chars = []
            for b in raw:
                try:
                    chars.append(bytes([b]).decode(codec))
                except UnicodeDecodeError:
                    chars.append(chr(b))  # bytes that the encoding leaves open come through as control characters
            table.setdefault("".join(chars), c)
        out[codec] = table
    for wrote, read in SINGLE:
        table = {}
        for c in LETTERS:
            try:
                bad = c.encode(wrote).decode(read)
            except UnicodeError:
                continue
            if bad != c:
                table[bad] = c
        out[f"{wrote}>{read}"] = table
    return out


@lru_cache(1)
def suspect_pattern() -> str:
    """A Java pattern: each garbled form of more than one character, and odd signs.

    Forms are grouped by their first characters, so that a name is scanned once and not once per form.
    """
    forms = {bad for codec in MULTI for bad, c in spans()[codec].items() if c in LETTERS + SIGNS}

    def quote(chars: str) -> str:
        return "".join(f"\\x{{{ord(c):x}}}" for c in chars)

    tails: dict[str, set[str]] = {}
    for form in forms:
        tails.setdefault(form[:-1], set()).add(form[-1])
    heads: dict[str, list[str]] = {}
    for head, ends in tails.items():
        heads.setdefault("".join(sorted(ends)), []).append(head)
    parts = []
    for ends, starts in sorted(heads.items()):
        one = "".join(sorted(x for x in starts if len(x) == 1))
        parts += [f"[{quote(one)}][{quote(ends)}]"] * bool(one) + [f"{quote(x)}[{quote(ends)}]" for x in sorted(starts) if len(x) > 1]
    return "|".join([*parts, f"[{quote(LOST + ODD)}]", BLANKED])


@lru_cache(1)
def lead_characters() -> str:
    """With one of these every garbled form begins."""
    return "".join(sorted({bad[0] for codec in MULTI for bad, c in spans()[codec].items() if c in LETTERS + SIGNS} | set(LOST + ODD)))


def suspect(name: Column, land: Column | None = None) -> Column:
    """Whether `name` holds a span that wrong decoding makes. Null is not suspect.

    With `land`, letters foreign to Polish make a Polish name suspect, too.
    """
    may = name.rlike("[^\\x00-\\x7f]") & (F.translate(name, lead_characters(), "") != name)  # cheap, and false for most names
    out = F.coalesce(may & name.rlike(suspect_pattern()), F.lit(False))
    if land is not None:
        out = out | F.coalesce((F.upper(land) == "PL") & name.rlike(f"[{FOREIGN}]"), F.lit(False))
    return out


def lattice(word: str, codec: str) -> list[tuple[str, float]]:
    """Readings of `word` if spans of it were read in `codec`, with the bits of their path, cheapest first."""
    table = spans()[codec]
    beams: list[dict[str, float]] = [{} for _ in range(len(word) + 1)]
    beams[0][""] = 0.0
    for i in range(len(word)):
        if not beams[i]:
            continue
        best = sorted(beams[i].items(), key=lambda x: x[1])[:BEAM]
        c = word[i]
        keep = 0.0 if c.isascii() or c in LETTERS or c == LOST else ODD_BITS / 3
        for text, bits in best:
            to = beams[i + 1]
            if bits + keep < to.get(text + c, 1e9):
                to[text + c] = bits + keep
        for n in (1, 2, 3):
            if i + n <= len(word) and (c2 := table.get(word[i : i + n])):
                for text, bits in best:
                    to = beams[i + n]
                    if bits < to.get(text + c2, 1e9):
                        to[text + c2] = bits
    ends = sorted(beams[-1].items(), key=lambda x: x[1])[:BEAM]
    return ends + [(full, bits + more) for text, bits in ends for full, more in filled(text)]


def filled(text: str) -> list[tuple[str, float]]:
    """`text` with every letter in its holes, with the bits of the choice; none without holes or with more than HOLES.

    A hole is up to three U+FFFD in a row, the bytes of one letter. Only letters beyond ASCII lose bytes; a hole
    before a small letter holds a small one, at the start of a word rather a capital. Which letter it is, the word's frequency tells.
    """
    parts = re.split(f"{LOST}{{1,3}}", text)
    if not 1 < len(parts) <= HOLES + 1:
        return []
    out = [parts[0]]
    for before, after in pairwise(parts):
        beside = before[-1:] + after[:1]
        wild = [c for c in sorted(LETTERS, key=str.islower) if not (beside[-1:].islower() and before and c.isupper() or beside.isupper() and len(beside) > 1 and c.islower())]
        out = [x + c + after for x in out for c in wild]
    return [(x, WILD_BITS * (len(parts) - 1)) for x in out]


def readings(word: str) -> list[tuple[str, str, float]]:
    """(reading, encoding, channel bits): the word as it stands, and all that up to ROUNDS wrong decodings explain."""
    out: dict[tuple[str, str], float] = {(word, ""): 0.0}
    if word.isascii():
        return [(word, "", 0.0)]
    for codec in spans():
        layer = {word: 0.0}
        for turn in range(ROUNDS if ">" not in codec else 1):
            found: dict[str, float] = {}
            for text, bits in layer.items():
                for got, more in lattice(text, codec):
                    if got != text:
                        found[got] = min(found.get(got, 1e9), bits + more + ROUND_BITS)
            if not found:
                break
            whole = {got: bits for got, bits in found.items() if LOST in got or LOST not in word}
            layer = dict(sorted(whole.items(), key=lambda x: x[1])[:BEAM])  # holes that are filled are read no further
            for got, bits in (layer | {got: bits for got, bits in found.items() if got not in whole}).items():
                out[got, codec] = min(out.get((got, codec), 1e9), bits)
            if not layer:
                break
    return [(w, c, b) for (w, c), b in out.items()]


SPLIT = re.compile(r"([ \t\n\r]+)")


@lru_cache(1)
def garbled_form() -> re.Pattern:
    forms = {bad for codec in MULTI for bad, c in spans()[codec].items() if c in LETTERS + SIGNS}
    return re.compile("|".join(map(re.escape, sorted(forms, key=lambda x: (-len(x), x)))) + f"|[{ODD}]")


def odd_letters(word: str) -> int:
    """Garbled forms and characters that no name uses."""
    rest, n = garbled_form().subn("", word)
    return n + sum(not (c.isascii() or c in LETTERS or c in SIGNS or c.isspace() or c == LOST) for c in rest)


def unblank(name: str) -> str:
    """BLANKED undone: the wildcard byte can only have been 0xA0."""
    return re.sub(BLANKED, lambda m: "Ã\xa0" + " " * (name[m.end()].isupper()), name)


def read_words(names: Column) -> Column:
    """The readings of every word of a name, as an array of READING; blanks between words count as words."""

    @F.pandas_udf(T.ArrayType(READING))
    def read(batch: pd.Series) -> pd.Series:
        return pd.Series([[(i, w, c, b) for i, part in enumerate(SPLIT.split(unblank(x))) for w, c, b in readings(part)] for x in batch])

    return read(names)


def key_of(word: Column) -> Column:
    """Under what a word is counted: lower case, without signs around it."""
    return F.regexp_replace(F.lower(word), r"^[^\p{L}]+|[^\p{L}]+$", "")


def choose(options: list, total: float) -> str:
    """The cheapest reading of a name: Viterbi over its words, where the state is the encoding."""
    by_pos: dict[int, list] = {}
    for o in options:
        by_pos.setdefault(o["pos"], []).append(o)
    states: dict[str, tuple[float, tuple[str, ...]]] = {"": (0.0, ())}
    for pos in sorted(by_pos):
        nxt: dict[str, tuple[float, tuple[str, ...]]] = {}
        for o in by_pos[pos]:
            seen = o["seen"] or 0
            word = o["bits"] + (log2(total / seen) if seen else UNSEEN if any(map(str.isalpha, o["word"])) else 0.0) + ODD_BITS * odd_letters(o["word"])
            for state, (bits, path) in states.items():
                codec = o["codec"] or state  # a word that needs no repair leaves the encoding open
                cost = bits + word + (SWITCH if o["codec"] and o["codec"] != state else 0.0)
                if codec not in nxt or cost < nxt[codec][0]:
                    nxt[codec] = (cost, (*path, o["word"]))
        states = nxt
    best = min(states.values(), key=lambda x: x[0])
    return "".join(best[1])


def restore(names: DataFrame, corpus: DataFrame) -> DataFrame:
    """Restored names of the suspect rows of `names`.

    names: key columns, `name`, `land`. corpus: `name`, `land`; its rows that are not suspect give the word
    frequencies. Result: the key columns, `name`, `restored` (best reading) and `lost` (characters are gone
    for good). Rows whose best reading is the name as it stands are no case and give no row; null and empty
    names never are. Repeated rows each give a row.
    """
    keys = [c for c in names.columns if c not in ("name", "land")]
    words = F.explode(F.split("name", r"[ \t\n\r]+"))
    counts = (
        corpus.where(~suspect(F.col("name"), F.col("land")))
        .select(words.alias("w"))
        .select(key_of(F.col("w")).alias("k"))
        .where("k <> ''")
        .groupBy("k")
        .agg(F.count("*").alias("seen"))
    )
    odd = names.where(suspect(F.col("name"), F.col("land")))
    distinct = spread(odd.select("name").distinct())
    options = distinct.select("name", F.explode(read_words(F.col("name"))).alias("o")).select("name", "o.*").withColumn("k", key_of(F.col("word")))
    weighed = options.join(counts, "k", "left").withColumn("seen", F.coalesce("seen", F.lit(0)))
    rows = weighed.groupBy("name").agg(F.collect_list(F.struct("pos", "word", "codec", "bits", "seen")).alias("options"))
    total = counts.agg(F.sum("seen").alias("total"))

    @F.pandas_udf("string")
    def pick(options: pd.Series, totals: pd.Series) -> pd.Series:
        return pd.Series([choose(list(x), max(2.0, float(t or 2))) for x, t in zip(options, totals)])

    read = rows.crossJoin(F.broadcast(total)).select("name", pick("options", "total").alias("restored"))  # one row on the right
    lost = F.col("name").contains(LOST)
    return odd.join(read, "name").withColumn("lost", lost).where(lost | (F.col("restored") != F.col("name"))).select(*keys, "name", "restored", "lost")
