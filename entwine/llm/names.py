"""What a typed name says: its distinctive words apart from forms, kinds, places and given names."""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entwine.llm.words import ACTIVITIES, COUNTRIES, GIVEN, SHORT_FORMS, WORDS, plain

#: Distinct place names up to which the gazetteer is sent to the executors; a country has at most some 40,000 municipalities.
GAZETTEER_BOUND = 200_000

DOTTED = re.compile(r"(?<![^\W_])[^\W\d_](?:\.[^\W\d_])+(?![^\W_])")
#: A word, in which U+FFFD may stand, and the dot after it; without U+FFFD the second finds the same.
TOKEN, CLEAN = re.compile(r"([^\W_�]*�[^\W_]*(?:�[^\W_]*)*|[^\W_]+)(\.?)"), re.compile(r"([^\W_]+)(\.?)")
#: Umlauts written with two letters; taken together so that both spellings agree.
DIGRAPH = re.compile(r"(?<=[^\W\d_])([aou])e")


@lru_cache(1)
def lexicon() -> tuple[dict[str, frozenset[str]], dict[str, str], frozenset[str], dict[str, str | None], dict[str, str]]:
    """Lands of each general word, given names, activities, words one letter short, and prefixes."""
    lands: dict[str, set[str]] = {}
    for land, text in WORDS.items():
        for word in text.split():
            lands.setdefault(word, set()).add(land)
    given = {form: name for name, forms in GIVEN.items() for form in forms.split()} | {name: name for name in GIVEN}
    long = [w for w in lands if len(w) >= 6]
    near: dict[str, str | None] = {}
    for word in long:  # every word with one letter left out; a typed word is near if one of its own such forms, or itself, is here
        for i in range(len(word)):
            near.setdefault(word[:i] + word[i + 1 :], word)
    starts: dict[str, str] = {}
    for word in sorted(lands, key=len):
        for n in range(2, len(word)):
            starts.setdefault(word[:n], word)
    return {w: frozenset(x) for w, x in lands.items()}, given, frozenset(ACTIVITIES.split()), near, starts


@lru_cache(1 << 16)
def near_word(token: str) -> str | None:
    """The general word that `token` is with one letter dropped, added, changed or two swapped."""
    lands, _, _, near, _ = lexicon()
    if len(token) < 5:
        return None
    if token in near:
        return near[token]
    if len(token) < 7:  # with a letter left out these are too short for what follows
        return None
    # left out late a letter leaves the head, left out early the tail: most tokens share neither with a word
    heads, tails = edges()
    for i in range(0 if token[-min(4, len(token) - 4) :] in tails else 4, len(token) if token[:4] in heads else 4):
        short = token[:i] + token[i + 1 :]
        if len(short) >= 6 and short in lands:
            return short
        word = near.get(short)
        if word and abs(len(word) - len(token)) <= 1 and (len(word) == len(token)) and len(word) >= 7:
            return word
    return None


@lru_cache(1)
def edges() -> tuple[frozenset[str], frozenset[str]]:
    """First four, and last three or four, letters of all that near_word() looks for with a letter left out."""
    lands, _, _, near, _ = lexicon()
    sought = {w for w in (*lands, *near) if len(w) >= 6}
    return frozenset(w[:4] for w in sought), frozenset(w[-n:] for w in sought for n in (3, 4))


@lru_cache(1 << 12)
def starts_activity(token: str) -> bool:
    return any(word.startswith(token) for word in lexicon()[2])


def parse_name(name: str | None, places: frozenset[str] = frozenset()) -> tuple[list[str], str | None, str | None, list[str], list[str]]:
    """Distinctive words in order, an initial among them, the given name, activities, and lands of the general words.

    A null or empty name gives no words. U+FFFD stays part of its word, as one unknown letter.
    """
    if not name:
        return [], None, None, [], []
    lands, given_names, activities, _, starts = lexicon()
    text = plain(name)
    if "." in text:
        text = DOTTED.sub(lambda m: m[0].replace(".", ""), text)
    core, doubtful, acts, initials, weak, given, votes = [], [], set(), [], [], None, []
    tokens = (TOKEN if "�" in text else CLEAN).findall(text)

    def general(word: str) -> None:
        if word in activities:
            acts.add(word)
        if word in lands:
            votes.append(lands[word])

    def abbreviated(token: str) -> None:
        """What it stands for stays open: no vote for a land, and an activity only by its beginning."""
        if starts_activity(token):
            acts.add(token)

    for at, (token, dot) in enumerate(tokens):
        if len(token) == 1:
            after = tokens[at + 1][0] if at + 1 < len(tokens) else ""
            if dot and not (token == "s" and after.startswith("coop")):
                initials.append(token)
            elif not dot and (not at or tokens[at - 1][0] not in ("sp", "spolka")) and after[:7] not in ("inserti", "interet", "respons"):
                weak.append(token)
            continue
        word = SHORT_FORMS.get(token)
        if word is not None and (dot or token not in ("ci", "ne", "st", "tr", "soc")):
            for part in word.split():
                general(part)
        elif token in lands:
            general(token)
        elif dot and token in starts:
            abbreviated(token)
        elif token in given_names and not given:
            given = token
        elif token in places or token in ("san", "sao", "saint", "vila"):
            continue
        elif token in SHORT_FORMS or near_word(token) or len(token) >= 2 and token in starts:
            doubtful.append((len(core), token))
        else:
            if "ae" in token or "oe" in token or "ue" in token:
                token = DIGRAPH.sub(r"\1", token)
            core.append(token.replace("ph", "f"))
    for shift, (place, token) in enumerate(doubtful):  # too few certain words: the doubtful ones belong to the name
        if len(core) - shift < 2 and not (len(core) == 1 and (initials or given)):
            core.insert(place + shift, token)
        else:
            word = near_word(token)
            general(word) if word else abbreviated(token)
    if given and len(core) < 2 and not (core and initials):  # one surname, or a surname that looks like a given name
        core.append(given if votes else given_names[given])
    if len(core) == 1 and not initials:
        initials = weak
    common = frozenset.intersection(*votes) if votes else frozenset()
    return core, initials[0] if initials else None, given and given_names[given], sorted(acts), sorted(common)


def gazetteer(places: DataFrame) -> frozenset[str]:
    """Folded words of the distinct values of the only column of `places`, at most GAZETTEER_BOUND of them."""
    rows = places.where(F.col(places.columns[0]).isNotNull()).distinct().limit(GAZETTEER_BOUND + 1).collect()
    if len(rows) > GAZETTEER_BOUND:
        raise ValueError(f"more than {GAZETTEER_BOUND} place names: not a column of places")
    names = [form for r in rows for form in (plain(r[0]), plain(r[0].lower().replace("ä", "ae").replace("ö", "oe").replace("ü", "ue")))]
    return frozenset(w for name in names for w in re.findall(r"[^\W\d_]+", name) if len(w) >= 2)


def with_line(df: DataFrame, name: str, places: frozenset[str] = frozenset()) -> DataFrame:
    """`df` with parse_name() of column `name` packed in one text, `line`: words, initial, given name, activities, lands, with tabs between.

    One line of text costs less to transfer and to keep than nested columns. The function is marked as not
    deterministic so that no filter on its result runs it twice.
    """

    shared = df.sparkSession.sparkContext.broadcast(places)

    @F.pandas_udf("string")
    def parse(names: pd.Series) -> pd.Series:
        return pd.Series(["\t".join((" ".join(c), i or "", g or "", " ".join(a), " ".join(z))) for c, i, g, a, z in (parse_name(x, shared.value) for x in names)])

    return df.withColumn("line", parse.asNondeterministic()(F.col(name)))


def land_of(hint: Column) -> Column:
    """Country code of a code or a country's name in any usual language, else null."""
    folded = F.regexp_replace(F.lower(F.translate(F.trim(hint), "ÑñÃãÇçÖöÅåÁáÉé", "nnaaccooaaaaee")), "[^a-z]", "")
    pairs = [F.lit(x) for land, forms in COUNTRIES.items() for form in dict.fromkeys(forms.split()) for x in (form, land)]
    return F.create_map(*pairs)[folded]
