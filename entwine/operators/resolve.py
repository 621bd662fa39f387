"""Trusted rosters resolved against the register, with a queue for review; and the roster rebuilt from its parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entwine.functions import ids, text
from entwine.operators import matching
from entwine.operators.nearest import nearest
from entwine.plans.durable import durable


def rendered(candidates: Column) -> Column:
    """Candidates as id|name|score, joined by '; '."""
    return F.array_join(F.transform(candidates, lambda c: F.concat_ws("|", c["id"], F.coalesce(c["name"], F.lit("")), c["score"].cast("string"))), "; ")


def top_rows(names: DataFrame, rows: DataFrame, key: list[str], k: int) -> DataFrame:
    """`key` and candidates (array of score, id, name; the k best rows by score, then order). names: key, m_normal, score and what else finds the rows.

    A row found in two ways counts once. The ranks are cut on the map side, so a hot key costs k rows a task.
    """
    on = [c for c in names.columns if c in rows.columns]
    pairs = names.join(rows, on).groupBy(*key, "order").agg(F.first("score").alias("score"), F.first("id").alias("id"), F.first("name").alias("name"))
    ranked = pairs.withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("score"), "order"))).where(F.col("_rank") <= k)
    entry = F.struct("_rank", "score", "id", "name")
    return ranked.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(entry)), lambda x: F.struct(x["score"].alias("score"), x["id"].alias("id"), x["name"].alias("name"))).alias("candidates"))


def with_ids(master: DataFrame) -> DataFrame:
    """Canonical rows with a deterministic entity_id, where they have none."""
    made = ids.entity_id(F.col("country"), F.col("tax_id_root"), F.col("tax_id"), F.col("ei_register_name"), F.col("ei_registration_number"), F.col("entity_name_norm"))
    if "entity_id" not in master.columns:
        return master.withColumn("entity_id", made)
    return master.withColumn("entity_id", F.coalesce(F.nullif(F.col("entity_id"), F.lit("")), made))


def roster_side(roster: DataFrame, key: str = "row_id") -> DataFrame:
    return roster.select(F.col(key).alias("r_key"), text.name_for_resolving(F.col("raw_brand_name")).alias("normal"), F.upper(text.strip(F.coalesce("country_hint", F.lit("")))).alias("land"), ids.domain(F.col("website_hint")).alias("domain"))


def master_side(master: DataFrame, name: str, website: str | None = None, order: str = "row_id") -> DataFrame:
    """id, name, m_normal, land, domain, order of the rows with an id; `name` is what is compared."""
    web = ids.domain(F.col(website)) if website else F.lit("")
    return master.where("entity_id IS NOT NULL").select(F.col("entity_id").alias("id"), F.col("entity_name").alias("name"), text.name_for_resolving(F.col(name)).alias("m_normal"), F.upper(text.strip(F.coalesce("country", F.lit("")))).alias("land"), web.alias("domain"), F.col(order).alias("order"))


def group(kind: str, *parts: str) -> Column:
    return F.concat_ws("|", F.lit(kind), *parts)


def resolve_by_blocks(roster: DataFrame, master: DataFrame, name: str = "entity_name_norm", threshold: float = 92.0, prefix: int = 4, widen: int = 50, most: int | None = None, token_k: int = 2, k: int = 5, least: float = 0.0) -> DataFrame:
    """One row per roster row: r_key, entity_id, match_method, match_score, candidate_count, needs_review, best_score, top_candidates.

    Candidates share country and first letters. Where these are fewer than `widen`, rows of the country that contain
    the name's first chosen token come in, too, however many; a name without tokens meets its whole country. Only who
    asks for it by `most` leaves candidates out: of `most` or more with a token only those with the next token stay,
    and so on, and rows with more than `most` candidates go to review as too_many_candidates. Blank countries and
    names give missing_country_or_name. Of equal scores the first row wins.
    With `least` names under that score are no candidates for the list: enough for who needs matches and no review.
    """
    left, right = durable(roster_side(roster)), master_side(master, name)
    fit = left.where("land <> '' AND normal <> ''").withColumn("block", text.letters_prefix(F.col("normal"), prefix)).withColumn("tokens", text.chosen_tokens(F.col("normal"), token_k))
    right = durable(right.join(fit.select("land").distinct(), "land", "left_semi").withColumn("block", text.letters_prefix(F.col("m_normal"), prefix)))
    lands = right.groupBy("land").agg(F.count("*").alias("in_land"))
    blocks = right.where("block <> ''").groupBy("land", "block").agg(F.count("*").alias("in_block"))
    asked = fit.select("land", "normal", "block", "tokens").distinct().join(lands, "land").join(blocks, ["land", "block"], "left").withColumn("in_block", F.coalesce("in_block", F.lit(0)))
    few, depths = asked.where(F.col("in_block") < widen), 1 if most is None else token_k
    # rows of the country that contain the tokens, one narrowing after the other
    names = right.where("m_normal <> ''").groupBy("land", "m_normal").agg(F.count("*").alias("rows"))
    reach = few.where(F.size("tokens") > 0).select("land", F.explode(F.slice("tokens", 1, depths)).alias("token")).distinct()
    holding = durable(matching.containing(names, "m_normal", reach, "token", ["land"]))
    open_to, held, narrowed = few.where(F.size("tokens") > 0).select("land", "normal", "tokens"), None, None
    for depth in range(1, depths + 1):
        wanted = open_to.where(F.size("tokens") >= depth).select("land", F.slice("tokens", 1, depth).alias("used")).distinct()
        step = wanted.withColumn("token", F.element_at("used", depth)).join(holding, ["land", "token"]).drop("token")
        if held is not None:
            step = step.join(held.select("land", "m_normal", F.col("used").alias("before")), ["land", "m_normal"]).where(F.slice("used", 1, depth - 1) == F.col("before")).drop("before")
        held = durable(step)
        sized = held.groupBy("land", "used").agg(F.sum("rows").alias("in_tokens"))
        here = open_to.where(F.size("tokens") >= depth).withColumn("used", F.slice("tokens", 1, depth)).join(sized, ["land", "used"], "left").withColumn("in_tokens", F.coalesce("in_tokens", F.lit(0)))
        enough = F.lit(True) if most is None else (F.col("in_tokens") < most) | (F.size("tokens") == depth)
        chosen = (here.where(enough).select("land", "normal", "used", "in_tokens"), held)
        narrowed = [chosen] if narrowed is None else [*narrowed, chosen]
        open_to = here.where(~enough).select("land", "normal", "tokens")
    by_token = narrowed[0][0]
    members = narrowed[0][1].select("land", "used", "m_normal")
    for found, step in narrowed[1:]:
        by_token, members = by_token.unionByName(found), members.unionByName(step.select("land", "used", "m_normal"))
    word = F.array_join("used", " ")
    by_token = durable(by_token.withColumn("group", F.concat_ws("|", F.lit("t"), "land", word)))
    bare = few.where(F.size("tokens") == 0).select("land", "normal", F.col("in_land").alias("in_tokens"), group("c", "land").alias("group"))
    wide = by_token.select("land", "normal", "in_tokens", "group").unionByName(bare)
    # rows that stand in the block and hold the tokens count once
    twice = few.where("in_block > 0").select("land", "normal", "block").join(by_token, ["land", "normal"]).join(right.select("land", "block", "m_normal"), ["land", "block"])
    twice = twice.where(F.forall("used", lambda t: F.col("m_normal").contains(t))).groupBy("land", "normal").agg(F.count("*").alias("twice"))
    twice = twice.unionByName(few.where((F.size("tokens") == 0) & (F.col("in_block") > 0)).select("land", "normal", F.col("in_block").alias("twice")))
    counted = asked.join(wide.select("land", "normal", "in_tokens"), ["land", "normal"], "left").join(twice, ["land", "normal"], "left")
    counted = durable(counted.select("land", "normal", "block", (F.col("in_block") + F.coalesce("in_tokens", F.lit(0)) - F.coalesce("twice", F.lit(0))).alias("candidate_count")))
    many = F.lit(False) if most is None else F.col("candidate_count") > most
    fair = counted.where((F.col("candidate_count") >= 1) & ~many)
    in_block = fair.where("block <> ''").select("land", "normal", group("p", "land", "block").alias("group"))
    queries = in_block.unionByName(wide.select("land", "normal", "group").join(fair.select("land", "normal"), ["land", "normal"], "left_semi"))
    first = right.select("land", "block", "m_normal", F.col("order").alias("first"))
    in_tokens = members.join(first, ["land", "m_normal"]).select(F.concat_ws("|", F.lit("t"), "land", F.array_join("used", " ")).alias("group"), "m_normal", "first")
    targets = first.where("block <> ''").select(group("p", "land", "block").alias("group"), "m_normal", "first").unionByName(in_tokens).unionByName(first.join(bare.select("land").distinct(), "land", "left_semi").select(group("c", "land").alias("group"), "m_normal", "first"))
    near = nearest(queries.select("group", "normal"), targets, k, least).join(queries, ["group", "normal"]).select("land", "normal", "m_normal", "score").distinct()
    tops = top_rows(near, right.select("land", "m_normal", "id", "name", "order"), ["land", "normal"], k)
    out = left.join(lands, "land", "left").join(counted.drop("block"), ["land", "normal"], "left").join(tops, ["land", "normal"], "left")
    count, best = F.col("candidate_count"), F.col("candidates")[0]
    method = (
        F.when((F.col("land") == "") | (F.col("normal") == ""), "missing_country_or_name").when(F.col("in_land").isNull(), "no_master_for_country").when(count == 0, "no_candidates")
        .when(many, "too_many_candidates").when(best.isNull(), "no_match").when(best.score >= threshold, "fuzzy_blocked").otherwise("below_threshold")
    )
    hit = F.coalesce(best.score >= threshold, F.lit(False))
    return out.select("r_key", F.when(hit, best.id).alias("entity_id"), method.alias("match_method"), best.score.alias("match_score"), count.cast("double").alias("candidate_count"), (~hit).alias("needs_review"), F.when(method == "below_threshold", best.score).alias("best_score"), F.when(method == "below_threshold", rendered(F.col("candidates"))).alias("top_candidates"))


def review_by_blocks(resolved: DataFrame, most: int = 200_000) -> DataFrame:
    """The review queue of resolve_by_blocks(): rows with too many candidates, with a note, and rows below the threshold, with their best candidates."""
    note = F.when(F.col("match_method") == "too_many_candidates", F.concat(F.lit("Too many candidates ("), F.col("candidate_count").cast("bigint").cast("string"), F.lit("). Consider adding tax_id/registration hints or more specific tokens.")))
    return resolved.where(F.col("match_method").isin("too_many_candidates", "below_threshold")).select("r_key", note.alias("notes"), "best_score", "top_candidates")


def resolve_by_domain(roster: DataFrame, master: DataFrame, website: str, name: str = "entity_name", threshold: float = 92.0, most: int = 25, k: int = 5) -> DataFrame:
    """One row per roster row: r_key, entity_id, match_method, match_score, match_candidate_count, needs_review, candidates.

    A single register row of the same country and web domain decides; several are told apart by name; above `most`
    of them, or without any, the most similar name of the whole country decides. Below the threshold the k best
    candidates are listed for review. Of equal scores the first row wins.
    """
    left, right = durable(roster_side(roster)), durable(master_side(master, name, website))
    counts = right.where("domain <> ''").groupBy("land", "domain").agg(F.count("*").alias("n"), F.min_by("id", "order").alias("only"))
    lands = right.groupBy("land").agg(F.count("*").alias("in_land"))
    keyed = left.join(counts, ["land", "domain"], "left").join(lands, "land", "left")
    few = F.coalesce(F.col("n"), F.lit(0)).between(1, most)
    named = F.col("normal") != ""
    place = F.when(few & (F.col("n") > 1), group("d", "land", "domain")).when(~few & named & F.col("in_land").isNotNull(), group("c", "land"))
    keyed = durable(keyed.withColumn("group", place))
    both = right.withColumn("group", F.explode(F.array(group("c", "land"), F.when(F.col("domain") != "", group("d", "land", "domain"))))).where("group IS NOT NULL")
    near = nearest(keyed.where("group IS NOT NULL").select("group", "normal"), both.select("group", "m_normal", F.col("order").alias("first")), k)
    tops = top_rows(near.select("group", "normal", "m_normal", "score"), both.select("group", "m_normal", "id", "name", "order"), ["group", "normal"], k)
    out = keyed.join(tops, ["group", "normal"], "left")
    best = F.col("candidates")[0]
    high = F.coalesce(best.score >= threshold, F.lit(False))
    method = (
        F.when(~named & (F.col("domain") == ""), "empty").when(few & (F.col("n") == 1), "domain_exact").when(few & high, "domain+fuzzy").when(few, "domain_ambiguous")
        .when(~named | F.col("in_land").isNull(), "no_country_index").when(best.isNull(), "no_candidates").when(high, "fuzzy_country").otherwise("fuzzy_below_threshold")
    )
    done = method.isin("domain_exact", "domain+fuzzy", "fuzzy_country")
    points = F.when(method == "domain_exact", F.lit(100.0)).when(method == "domain_ambiguous", F.coalesce(best.score, F.lit(0.0))).otherwise(best.score)
    count = F.when(method.isin("empty", "no_country_index"), F.col("n")).when(few, F.col("n")).otherwise(F.col("in_land"))
    chosen = F.when(method == "domain_exact", F.col("only")).otherwise(best.id)
    listed = method.isin("domain_ambiguous", "fuzzy_below_threshold")
    return out.select("r_key", F.when(done, chosen).alias("entity_id"), method.alias("match_method"), points.alias("match_score"), count.cast("double").alias("match_candidate_count"), (~done).alias("needs_review"), F.when(listed, rendered(F.col("candidates"))).alias("candidates"))


def review_by_domain(resolved: DataFrame, threshold: float = 92.0) -> DataFrame:
    """The review queue of resolve_by_domain(): what is ambiguous or below the threshold, with a note and the best candidates."""
    note = F.when(
        F.col("match_method") == "domain_ambiguous", F.concat(F.lit("Domain matched "), F.col("match_candidate_count").cast("bigint").cast("string"), F.lit(f" candidates; none cleared threshold {threshold:g}"))
    ).otherwise(F.concat(F.lit("Best score "), F.col("match_score").cast("string"), F.lit(f" below threshold {threshold:g}")))
    return resolved.where(F.col("match_method").isin("domain_ambiguous", "fuzzy_below_threshold")).select("r_key", "match_method", note.alias("notes"), "candidates")


ENRICHMENT = ("website_hint", "business_summary", "identified_clients", "sector", "clients_publicly_referenced", "trusted_reason")


#: Headers that roster files use, in order of preference, for each column.
HEADERS = {"raw_brand_name": ("organisation", "organization", "name"), "country_hint": ("country",), "website_hint": ("website",)}
#: Headers of the directory, and what each becomes.
DIRECTORY = {
    "Organisation": "raw_brand_name", "Country": "country_hint", "Website": "website_hint", "Business Summary": "business_summary", "Identified Clients": "identified_clients", "Sector": "sector",
    "Clients Publicly Referenced (Yes/No)": "clients_publicly_referenced",
}


def roster_columns(df: DataFrame) -> DataFrame:
    """`df` with the roster's columns: each that it lacks from a known header in any case, else ''; `source` is TRUSTED_ROSTER where it has none."""
    low = {c.lower(): c for c in reversed(df.columns)}
    for column, headers in HEADERS.items():
        if column not in df.columns:
            found = next((low[h] for h in headers if h in low), None)
            df = df.withColumn(column, F.col(f"`{found}`") if found else F.lit(""))
    return df if "source" in df.columns else df.withColumn("source", F.lit("TRUSTED_ROSTER"))


def directory_rows(df: DataFrame) -> DataFrame:
    """The directory in the roster's columns, without blank names; an error names the headers that are missing. Other columns are kept."""
    missing = [c for c in DIRECTORY if c not in df.columns]
    if missing:
        raise ValueError(f"directory lacks the columns {missing}")
    tidy = lambda c: text.strip(F.coalesce(F.col(f"`{c}`"), F.lit(""))) if DIRECTORY[c] in ("raw_brand_name", "country_hint", "website_hint") else F.coalesce(F.col(f"`{c}`"), F.lit(""))
    fixed = {"trusted_reason": "Existing directory entry (V22 blog import)", "publish_status": "published", "source": "DIRECTORY_V22"}
    rest = [c for c in df.columns if c not in DIRECTORY and c not in fixed and c not in DIRECTORY.values()]
    return df.select(*rest, *[tidy(c).alias(t) for c, t in DIRECTORY.items()], *[F.lit(v).alias(c) for c, v in fixed.items()]).where("raw_brand_name <> ''")


def rebuild_roster(parts: list[tuple[DataFrame, int]], key: str = "row_id") -> DataFrame:
    """One row per roster key: of the part with the higher priority, then with most filled fields, then the least `key`.

    parts: data and priority; columns that a part lacks become ''. Rows with a blank name
    fall away. The result is ordered by roster key, priority and filled fields, the last two downwards.
    """
    aligned = None
    every = list(dict.fromkeys(c for df, _ in parts for c in df.columns))
    for df, priority in parts:
        padded = df.select(*[F.col(c) if c in df.columns else F.lit("").alias(c) for c in every], F.lit(priority).alias("priority"))
        aligned = padded if aligned is None else aligned.unionByName(padded)
    named = aligned.withColumn("roster_key", text.roster_key(F.col("raw_brand_name"))).where("roster_key <> ''")
    counted = named.withColumn("filled", ids.filled(*[F.col(c) for c in ENRICHMENT if c in every]))
    best = F.max_by(F.struct(*every, "priority", "filled"), F.struct("priority", "filled", -F.col(key)))
    return counted.groupBy("roster_key").agg(best.alias("b")).select("roster_key", "b.*").orderBy("roster_key", F.desc("priority"), F.desc("filled"))
