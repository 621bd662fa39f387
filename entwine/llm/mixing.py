"""Sources mixed to target shares of tokens (problem 9).

Water filling: every source may give its tokens times its most repeats; sources whose target asks for more are
clamped there, and the shares of the others are redistributed in proportion until all fit. Documents are then
taken whole times, and a seeded part of each source once more. Totals and a histogram over hash bins are all that
leaves the data; no source is ever gathered in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import floor

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entwine.plans.durable import durable, spread

#: Bins of the seeded order of a source; the share of the last bin is settled by its documents' order in it.
BINS = 4096
#: Where the public vocabularies are unless said otherwise.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the split of that vocabulary before its merges.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


def counted(documents: DataFrame, ranks: str = RANKS) -> DataFrame:
    """`documents` (doc_id, source, text) as doc_id, source, n_tokens by a public tokenizer; a null text has none."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import base64

        import tiktoken

        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        coder = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})
        for batch in batches:
            sizes = [len(coder.encode_ordinary(t)) if t else 0 for t in batch.text]
            yield pd.DataFrame({"doc_id": batch.doc_id, "source": batch.source, "n_tokens": sizes})

    return spread(documents.select("doc_id", "source", "text")).mapInPandas(count, "doc_id long, source string, n_tokens long")


def water_fill(targets: dict[str, tuple[float, int]], tokens: dict[str, int], total: float | None = None) -> dict[str, float]:
    """How often each source is used on average, for the largest mixture in which shares are met as far as they can be.

    targets: share and most repeats by source. total: tokens of the mixture; by default the largest at which at
    most the sources that cannot give their share even once clamp, that is the tokens of all targeted sources.
    Sources without tokens or target give nothing; a total beyond what all can give is cut to that.
    """
    have = {s: t for s, t in tokens.items() if t > 0 and s in targets and targets[s][0] > 0 and targets[s][1] > 0}
    if not have:
        return {}
    most = {s: t * targets[s][1] for s, t in have.items()}
    want = min(float(sum(have.values()) if total is None else total), float(sum(most.values())))
    gives: dict[str, float] = {}
    while True:
        left, weight = want - sum(gives.values()), sum(targets[s][0] for s in have if s not in gives)
        over = [s for s in have if s not in gives and left * targets[s][0] / weight >= most[s]]
        if not over:
            break
        gives |= {s: float(most[s]) for s in over}
        if len(gives) == len(have):
            break
    gives |= {s: left * targets[s][0] / weight for s in have if s not in gives}
    return {s: g / have[s] for s, g in gives.items()}


def mix(documents: DataFrame, targets: DataFrame, seed: int = 7, total: float | None = None, ranks: str = RANKS) -> tuple[DataFrame, DataFrame]:
    """(selection, shares): doc_id, source, n_tokens, copies of every used document; and the shares reached by source.

    documents: doc_id, source, text; targets: source, target_share, max_repeats, one row per source (of several
    the first by share counts). Sources not targeted, null among them, are not used and have share 0.
    """
    spark: SparkSession = documents.sparkSession
    sizes = durable(counted(documents, ranks).withColumn("bin", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(BINS)).cast("int")))
    asked = {r.source: (float(r.target_share), int(r.max_repeats)) for r in targets.where("source IS NOT NULL AND target_share IS NOT NULL AND max_repeats IS NOT NULL").orderBy(F.desc("target_share")).collect()[::-1]}
    named = spark.createDataFrame([(s,) for s in asked], "source string")  # as many rows as there are targets
    wanted = sizes.join(F.broadcast(named), "source")
    bins = wanted.groupBy("source", "bin").agg(F.sum("n_tokens").alias("n")).collect()  # at most BINS rows per target
    have: dict[str, dict[int, int]] = {}
    for r in bins:
        have.setdefault(r.source, {})[r.bin] = r.n
    uses = water_fill(asked, {s: sum(b.values()) for s, b in have.items()}, total)
    plan = []
    for source, use in uses.items():
        whole = min(floor(use + 1e-9), asked[source][1])
        rest, at = (use - whole) * sum(have[source].values()), 0
        while at < BINS and whole < asked[source][1] and have[source].get(at, 0) <= rest:
            rest -= have[source].get(at, 0)
            at += 1
        plan.append((source, whole, at if whole < asked[source][1] else 0, float(rest)))
    plans = F.broadcast(spark.createDataFrame(plan, "source string, whole int, edge int, rest double"))
    planned = sizes.join(plans, "source")
    # only the bin at the edge is ordered, one BINS-th of a source
    edge = planned.where("bin = edge").withColumn("sofar", F.expr("sum(n_tokens) OVER (PARTITION BY source ORDER BY xxhash64(doc_id, 1), doc_id ROWS UNBOUNDED PRECEDING)"))
    copies = F.col("whole") + F.when(F.col("bin") < F.col("edge"), 1).otherwise(0)
    columns = ("doc_id", "source", "n_tokens")
    chosen = planned.where("bin <> edge").select(*columns, copies.alias("copies")).unionByName(edge.select(*columns, (F.col("whole") + F.when(F.col("sofar") <= F.col("rest") + F.col("n_tokens") / 2, 1).otherwise(0)).alias("copies")))
    limits = F.broadcast(spark.createDataFrame([(s, m) for s, (_, m) in asked.items()], "source string, most int"))
    chosen = chosen.join(limits, "source").select(*columns, F.least("copies", "most").cast("int").alias("copies")).where("copies > 0")
    used = chosen.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"), F.max("copies").alias("repeats"))
    all_used = used.agg(F.sum("tokens").alias("of"))
    goals = spark.createDataFrame([(s, x, m) for s, (x, m) in asked.items()], "source string, target_share double, max_repeats int")
    available = sizes.groupBy("source").agg(F.sum("n_tokens").alias("available_tokens"))
    report = available.join(F.broadcast(goals), "source", "full").join(used, "source", "left").crossJoin(F.broadcast(all_used))  # one row on the right
    shares = report.select("source", "target_share", "max_repeats", F.coalesce("available_tokens", F.lit(0)).alias("available_tokens"), F.coalesce("tokens", F.lit(0)).alias("used_tokens"), F.coalesce("repeats", F.lit(0)).alias("repeats"), F.round(F.coalesce(F.col("tokens") / F.col("of"), F.lit(0.0)), 6).alias("actual_share"))
    return chosen, shares
