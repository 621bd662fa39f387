"""Text functions as native expressions, each with its SQL.

A function takes and gives a Column; its SQL twin takes and gives SQL text. Null gives null unless said otherwise.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from entwine.functions import values as V

EDGES = r"(?U)^\s+|\s+$"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(x: Column) -> Column:
    """Without blanks of any kind at the ends."""
    return F.regexp_replace(x, EDGES, "")


def strip_sql(x: str) -> str:
    return rf"regexp_replace({x}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"


def plain(x: Column) -> Column:
    """Lower case in ASCII letters as far as the table of letters goes."""
    out = F.translate(F.lower(x), V.PLAIN_FROM, V.PLAIN_TO)
    for a, b in V.PLAIN_PAIRS:
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def plain_sql(x: str) -> str:
    out = f"translate(lower({x}), {quoted(V.PLAIN_FROM)}, {quoted(V.PLAIN_TO)})"
    for a, b in V.PLAIN_PAIRS:
        out = f"replace({out}, {quoted(a)}, {quoted(b)})"
    return out


def chain(x: Column, steps: list[tuple[str, str]]) -> Column:
    for pattern, to in steps:
        x = F.regexp_replace(x, pattern, to)
    return x


def chain_sql(x: str, steps: list[tuple[str, str]]) -> str:
    for pattern, to in steps:
        x = f"regexp_replace({x}, {quoted(pattern)}, {quoted(to)}, 'g')"
    return x


MATCH_STEPS = [("[&/]", " "), (r"[^a-z0-9\s]", " "), (r"\b(" + "|".join(V.LEGAL_SUFFIXES) + r")\b", " "), (r"\s+", " "), (r"^ | $", "")]
REGISTER_STEPS = [(r"[^a-z0-9_\s]", " "), (r"\b(" + "|".join(V.REGISTER_FORMS) + r")\b", " "), (r"\b(" + "|".join(V.REGISTER_STOPWORDS) + r")\b", " "), (r"\s+", " "), (r"^ | $", "")]


def name_for_matching(x: Column) -> Column:
    """A name without accents, signs and legal suffixes; null and blank give ''."""
    return F.coalesce(chain(plain(x), MATCH_STEPS), F.lit(""))


def name_for_matching_sql(x: str) -> str:
    return f"coalesce({chain_sql(plain_sql(x), MATCH_STEPS)}, '')"


def name_for_resolving(x: Column) -> Column:
    """Lower case, single blanks, only letters, digits, blanks, & and -; accents stay. Null gives ''."""
    return F.coalesce(chain(F.lower(x), [(EDGES, ""), (r"(?U)\s+", " "), (r"(?U)[^\p{L}\p{N}_\s&-]", "")]), F.lit(""))


def name_for_resolving_sql(x: str) -> str:
    tidy = chain_sql(strip_sql(f"lower({x})"), [(r"[\s\p{Z}]+", " "), (r"[^\p{L}\p{N}_\s&-]", "")])
    return f"coalesce({tidy}, '')"


def name_for_register(x: Column) -> Column:
    """A name without accents, signs, Spanish legal forms and stop words; null gives ''."""
    return F.coalesce(chain(plain(x), REGISTER_STEPS), F.lit(""))


def name_for_register_sql(x: str) -> str:
    return f"coalesce({chain_sql(plain_sql(x), REGISTER_STEPS)}, '')"


def roster_key(x: Column) -> Column:
    """Key under which roster rows are one: as for resolving, and one group under all its names."""
    key = name_for_resolving(x)
    return F.when(key.rlike(r"^(grupo|group)\s+ilunion$"), "ilunion").otherwise(key)


def roster_key_sql(x: str) -> str:
    return rf"(CASE WHEN regexp_matches({name_for_resolving_sql(x)}, '^(grupo|group)\s+ilunion$') THEN 'ilunion' ELSE {name_for_resolving_sql(x)} END)"


def clean_text(x: Column) -> Column:
    """Single blanks, none at the ends; '' and 'nan' give null."""
    tidy = F.regexp_replace(strip(F.regexp_replace(x, " ", " ")), r"(?U)\s+", " ")
    return F.when(~F.lower(tidy).isin("", "nan"), tidy)


def clean_text_sql(x: str) -> str:
    tidy = chain_sql(strip_sql(f"replace({x}, chr(160), ' ')"), [(r"[\s\p{Z}]+", " ")])
    return f"CASE WHEN lower({tidy}) NOT IN ('', 'nan') THEN {tidy} END"


def block_key(normal: Column, n: int = 8) -> Column:
    return F.substring(normal, 1, n)


def letters_prefix(x: Column, n: int = 4) -> Column:
    """First n ASCII letters and digits of the lower-case text."""
    return F.substring(F.regexp_replace(F.lower(x), "[^a-z0-9]", ""), 1, n)


def letters_prefix_sql(x: str, n: int = 4) -> str:
    return f"substring(regexp_replace(lower({x}), '[^a-z0-9]', '', 'g'), 1, {n})"


def meaningful_tokens(normal: Column) -> Column:
    """Distinct tokens of at least four letters that are not generic."""
    return F.array_distinct(F.filter(F.split(normal, " "), lambda t: (F.length(t) >= 4) & ~t.isin(*V.GENERIC_TOKENS)))


def meaningful_tokens_sql(normal: str) -> str:
    generic = ", ".join(map(quoted, V.GENERIC_TOKENS))
    return f"list_distinct(list_filter(string_split({normal}, ' '), lambda t: length(t) >= 4 AND t NOT IN ({generic})))"


def too_generic(normal: Column) -> Column:
    """No meaningful token, or a single one of under eight letters."""
    tokens = meaningful_tokens(normal)
    return (F.size(tokens) == 0) | ((F.size(tokens) == 1) & (F.length(tokens[0]) < 8))


def chosen_tokens(x: Column, k: int = 2) -> Column:
    """The k longest words of at least four ASCII letters or digits that are no stop words, ties by alphabet."""
    words = F.array_distinct(F.filter(F.regexp_extract_all(F.lower(x), F.lit("[a-z0-9]+"), F.lit(0)), lambda t: (F.length(t) >= 4) & ~t.isin(*V.STOP_TOKENS)))
    return F.transform(F.slice(F.array_sort(F.transform(words, lambda t: F.struct((-F.length(t)).alias("n"), t.alias("t")))), 1, k), lambda s: s.t)


def chosen_tokens_sql(x: str, k: int = 2) -> str:
    stop = ", ".join(map(quoted, V.STOP_TOKENS))
    words = f"list_distinct(list_filter(regexp_extract_all(lower({x}), '[a-z0-9]+'), lambda t: length(t) >= 4 AND t NOT IN ({stop})))"
    return f"list_transform(list_sort(list_transform({words}, lambda t: {{'n': -length(t), 't': t}}))[1:{k}], lambda s: s.t)"


def too_generic_sql(normal: str) -> str:
    tokens = meaningful_tokens_sql(normal)
    return f"(len({tokens}) = 0 OR (len({tokens}) = 1 AND length({tokens}[1]) < 8))"


def contains_any(x: Column, words: tuple[str, ...]) -> Column:
    low, out = F.lower(F.coalesce(x, F.lit(""))), F.lit(False)
    for w in words:
        out = out | low.contains(w)
    return out


def contains_any_sql(x: str, words: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains(lower(coalesce({x}, '')), {quoted(w)})" for w in words) + ")"


def commercial_pattern() -> str:
    return r"\b(" + "|".join(f if f in V.WHOLE_FORMS else r"\.?\s*".join(f) + r"\.?" for f in V.COMMERCIAL_FORMS) + r")\b"


def is_commercial(x: Column) -> Column:
    """Whether a legal form of a company stands in the name."""
    return F.coalesce(x.rlike("(?iu)" + commercial_pattern()), F.lit(False))


def is_brand(x: Column, brands: tuple[str, ...] = V.SOCIAL_BRANDS, word_boundary: bool = True) -> Column:
    """Whether one of a small list of brands stands in the name, as whole words unless said otherwise."""
    edge = r"\b" if word_boundary else ""
    return F.coalesce(x.rlike("(?iu)" + "|".join(edge + re.escape(b) + edge for b in brands)), F.lit(False)) if brands else F.lit(False)


def edged_sql(x: str, body: str, word_boundary: bool = True) -> str:
    """Whether one of the alternatives in `body` stands in x, between edges of words."""
    before, after = (r"(?:^|[^\p{L}\p{N}_])", r"(?:$|[^\p{L}\p{N}_])") if word_boundary else ("", "")
    return f"coalesce(regexp_matches({x}, {quoted('(?i)' + before + '(?:' + body + ')' + after)}), false)"


def is_commercial_sql(x: str) -> str:
    """A form that ends in a dot has no edge of a word behind it unless a word follows, so the last dot stays out."""
    forms = "|".join(f if f in V.WHOLE_FORMS else r"\.?\s*".join(f) for f in V.COMMERCIAL_FORMS)
    return f"({edged_sql(x, forms)} OR coalesce(regexp_matches({x}, {quoted(dotted_form())}), false))"


def dotted_form() -> str:
    forms = "|".join(r"\.?\s*".join(f) for f in V.COMMERCIAL_FORMS if f not in V.WHOLE_FORMS)
    return r"(?i)(?:^|[^\p{L}\p{N}_])(?:" + forms + r")\.[\p{L}\p{N}_]"


def is_brand_sql(x: str, brands: tuple[str, ...] = V.SOCIAL_BRANDS, word_boundary: bool = True) -> str:
    return edged_sql(x, "|".join(re.escape(b) for b in brands), word_boundary)


def triggers(country: Column, name: Column) -> Column:
    """Categories of the country's name rules that the name meets, in their order."""
    land, text, out = F.upper(strip(F.coalesce(country, F.lit("")))), F.coalesce(name, F.lit("")), F.array().cast("array<string>")
    for code, rules in V.NAME_RULES.items():
        hits = [F.when(text.rlike("(?iu)" + "|".join(f"(?:{p})" for p in rules[c])), F.lit(c)) for c in V.CATEGORIES if c in rules]
        out = F.when(land == code, F.array_compact(F.array(*hits))).otherwise(out)
    return out


def classified(country: Column, name: Column) -> list[Column]:
    """name_coop_candidate, name_marker_candidate, name_candidate_reason, name_candidate_trigger, social_economy_name_candidate."""
    hit = triggers(country, name)
    yes = lambda x: F.when(x, "YES").otherwise("NO")
    bucket = F.create_map(*[F.lit(x) for pair in V.CATEGORIES.items() for x in pair])
    return [
        yes(F.array_contains(hit, "coop")).alias("name_coop_candidate"),
        yes(F.size(F.array_remove(hit, "coop")) > 0).alias("name_marker_candidate"),
        F.array_join(F.array_distinct(F.transform(hit, lambda t: bucket[t])), ",").alias("name_candidate_reason"),
        F.array_join(hit, ",").alias("name_candidate_trigger"),
        yes(F.size(hit) > 0).alias("social_economy_name_candidate"),
    ]


def edge_free(pattern: str) -> str:
    """A Java pattern in the dialect without look-ahead and with ASCII word edges only."""
    word, other = r"[\p{L}\p{N}_]", r"[^\p{L}\p{N}_]"
    if pattern.endswith(r"\.?)\b(?=\s*$)"):  # a word edge never follows a dot at the end
        pattern = pattern.replace(r"a\.?", "a")
    pattern = pattern.replace(r"\.?\b(?=\s*$)", r"\s*$").replace(r"\b(?=\s*$)", r"\s*$")
    pattern = re.sub(r"\\\.\?\\b$", lambda m: rf"(?:\.{word}|$|{other})", pattern)
    pattern = re.sub(r"\\\.\\b$", lambda m: rf"\.{word}", pattern)
    pattern = re.sub(r"^\\b", lambda m: f"(?:^|{other})", pattern)
    return re.sub(r"\\b$", lambda m: f"(?:$|{other})", pattern)


def triggers_sql(country: str, name: str) -> str:
    land, cases = f"upper({strip_sql(f"coalesce({country}, '')")})", []
    for code, rules in V.NAME_RULES.items():
        hits = []
        for c in V.CATEGORIES:
            if c in rules:
                any_of = " OR ".join(f"regexp_matches(coalesce({name}, ''), {quoted('(?i)' + edge_free(p))})" for p in rules[c])
                hits.append(f"CASE WHEN {any_of} THEN '{c}' END")
        cases.append(f"WHEN {land} = '{code}' THEN list_filter([{', '.join(hits)}], lambda t: t IS NOT NULL)")
    return "CASE " + " ".join(cases) + " ELSE [] END"


def classified_sql(country: str, name: str) -> dict[str, str]:
    hit = triggers_sql(country, name)
    bucket = "CASE t " + " ".join(f"WHEN '{t}' THEN '{b}'" for t, b in V.CATEGORIES.items()) + " END"
    buckets = f"list_transform({hit}, lambda t: {bucket})"
    yes = lambda x: f"CASE WHEN {x} THEN 'YES' ELSE 'NO' END"
    return {
        "name_coop_candidate": yes(f"list_contains({hit}, 'coop')"),
        "name_marker_candidate": yes(f"len(list_filter({hit}, lambda t: t <> 'coop')) > 0"),
        "name_candidate_reason": f"array_to_string(list_filter({buckets}, lambda b, i: list_position({buckets}, b) = i), ',')",
        "name_candidate_trigger": f"array_to_string({hit}, ',')",
        "social_economy_name_candidate": yes(f"len({hit}) > 0"),
    }


def legal_form(x: Column) -> Column:
    """The first of the form tokens in the upper-case name, without blanks."""
    out = F.lit(None).cast("string")
    for token in reversed(V.FORM_TOKENS):
        out = F.when(F.upper(x).contains(token), token.replace(" ", "")).otherwise(out)
    return out


def legal_form_sql(x: str) -> str:
    return "CASE " + " ".join(f"WHEN contains(upper({x}), '{t}') THEN '{t.replace(' ', '')}'" for t in V.FORM_TOKENS) + " END"


def form_family(form: Column) -> Column:
    up = F.upper(form)
    return F.when(up.contains("COOP"), "COOPERATIVE").when(up.contains("S.L") | up.contains("S.A"), "COMPANY_LIMITED")


def form_family_sql(form: str) -> str:
    return f"CASE WHEN contains(upper({form}), 'COOP') THEN 'COOPERATIVE' WHEN contains(upper({form}), 'S.L') OR contains(upper({form}), 'S.A') THEN 'COMPANY_LIMITED' END"
