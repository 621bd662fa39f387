"""The most similar names of a group for every queried name, exact, in blocks.

Names are scored with the weighted ratio of `similarity`. Groups are cut into blocks on both sides, so no task
holds a whole group. In a block words in common give the k-th best score a lower bound and letters in common give
each score an upper one; for names that can reach it, looked for from high scores to low, the longest common
subsequences are counted at once, a word of bits per name, and bound the scores again. Only names whose upper bound
reaches the k-th best are scored in full, those with the highest bounds first, so nothing is lost.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from entwine.functions.similarity import common_length, partial_ratio, weighted_ratio
from entwine.plans.durable import durable, shuffled, small_side, spread

#: Names of a block on the side of the targets and of the queries.
TARGETS, QUERIES = 32768, 512
#: Letters up to which a name's positions fit one word of bits, and bits for the letters of a name whatever their places.
BITS, BAG = 64, 192
#: Scores down to which names are looked for one after the other, until there are k of them; what rounding may change.
STEPS, EPSILON = (85.5, 70.0), 1e-6
RESULT = "group string, normal string, m_normal string, first long, score double"


class Block:
    """Targets of one group, encoded once for all queries of a block; `first` tells which of equal scores comes first."""

    def __init__(self, names: list[str], first: list[int] | None = None):
        self.names, self.first = names, np.arange(len(names)) if first is None else np.array(first, np.int64)
        tokens = [n.split() for n in names]
        self.turned_names = [" ".join(sorted(t)) for t in tokens]
        having: dict[str, list[int]] = {}
        for at, words in enumerate(tokens):
            for w in set(words):
                having.setdefault(w, []).append(at)
        self.having = {w: np.array(x) for w, x in having.items()}
        lengths = lambda texts: np.fromiter(map(len, texts), np.int64, len(names))
        self.length, self.turned_length = lengths(names), lengths(self.turned_names)
        self.set_length = self.turned_length.copy()
        for at, words in enumerate(tokens):
            if len(kinds := set(words)) < len(words):
                self.set_length[at] = len(" ".join(kinds))
        self.odd = np.flatnonzero(self.set_length < self.length)  # a word twice, or a blank more
        self.plain, self.turned = self.encoded(names), self.encoded(self.turned_names)
        # the n-th of a letter in a name is a bit; of more kinds than there are bits the rare ones count as common to all
        counts = {c: np.bitwise_count(masks) for c, masks in self.plain.items()}
        for at in np.flatnonzero(self.length > BITS):
            for c, n in Counter(names[at]).items():
                counts[c][at] = min(n, 255)
        often = {(c, i): n for c, count in counts.items() for i, n in enumerate(np.bincount(count)[::-1].cumsum()[::-1][1:])}
        self.bit = {x: i for i, x in enumerate(sorted(often, key=lambda x: -often[x])[:BAG])}
        self.bags = np.zeros((BAG // 64, len(names)), np.uint64)
        for (c, n), i in self.bit.items():
            self.bags[i // 64] |= (counts[c] > n).astype(np.uint64) << np.uint64(i % 64)

    @staticmethod
    def encoded(names: list[str]) -> dict[str, np.ndarray]:
        """For each letter a word of bits per name: where the letter stands in it. Longer names have none."""
        width = max(1, max(map(len, names)))
        points = np.array(names, f"<U{width}").view(np.uint32).reshape(len(names), width)
        kinds, codes = np.unique(points, return_inverse=True)
        codes = codes.reshape(points.shape)
        codes[points[:, BITS:].any(1) if width > BITS else np.zeros(len(names), bool)] = 0 if kinds[0] == 0 else len(kinds)
        masks, every = np.zeros((len(kinds) + 1, len(names)), np.uint64), np.arange(len(names))
        for i in range(min(width, BITS)):
            masks[codes[:, i], every] |= np.uint64(1 << i)
        return {chr(c): masks[i] for i, c in enumerate(kinds) if c}

    @staticmethod
    def common(encoded: dict[str, np.ndarray], query: str, names: list[str], at: np.ndarray) -> np.ndarray:
        """Lengths of the longest common subsequences of `query` and `names`, which are those numbered `at`."""
        row = np.full(len(at), ~np.uint64(0))
        for c in query:
            if c in encoded:
                hit = row & encoded[c][at]
                row = (row + hit) | (row - hit)
        out = np.bitwise_count(~row).astype(np.int64)
        long = [i for i, n in enumerate(names) if len(n) > BITS]
        if long and len(query) > BITS:
            out[long] = [common_length(query, names[i]) for i in long]
        elif long:  # the other way round, the bits are those of the query
            kinds = np.array(sorted({0, *map(ord, query)}), np.uint32)
            bits = np.array([sum(1 << i for i, c in enumerate(query) if ord(c) == x) for x in kinds], np.uint64)
            width = max(len(names[i]) for i in long)
            points = np.array([names[i] for i in long], f"<U{width}").view(np.uint32).reshape(len(long), width)
            found = np.minimum(np.searchsorted(kinds, points), len(kinds) - 1)
            masks = np.ascontiguousarray(np.where(kinds[found] == points, bits[found], np.uint64(0)).T)
            row = np.full(len(long), ~np.uint64(0))
            for column in masks:
                hit = row & column
                row = (row + hit) | (row - hit)
            out[long] = np.bitwise_count(~row)
        return out

    def best(self, query: str, k: int, cutoff: float) -> list[tuple[float, int]]:
        """(score, index) of the k best names of score `cutoff` or more, the least `first` of equal scores."""
        words = set(query.split())
        turned = " ".join(sorted(query.split()))
        n, nt, nd = len(query), len(turned), len(" ".join(words))
        held = np.zeros(len(self.names), np.int64)  # letters of the words in common, with blanks between
        for w in words:
            if w in self.having:
                held[self.having[w]] += len(w) + 1
        sharing = np.flatnonzero(held)
        held[sharing] -= 1
        known: list[tuple[float, int]] = []
        # what words in common give is a lower bound
        floor, seeds, last = -1.0, sharing[:0], 0
        if len(sharing) >= k:
            low = self.lowest(n, nd, held[sharing], self.length[sharing], self.set_length[sharing])
            floor = np.partition(low, -k)[-k]
            fair = sharing[low >= floor - EPSILON]
            order = np.lexsort((self.first[fair], -np.round(low[low >= floor - EPSILON], 6)))[:k]
            seeds, last = fair[order], self.first[fair[order[-1]]]
        least = max(cutoff, floor)
        shared = np.zeros(len(self.names), bool)
        shared[sharing] = True
        bits = [0] * (BAG // 64)
        beyond = 0
        for c in set(query):
            for i in range(query.count(c)):
                at = self.bit.get((c, i))
                if at is None:
                    beyond += 1
                else:
                    bits[at // 64] |= 1 << at % 64
        bag = np.full(len(self.names), beyond, np.uint8 if n < 256 else np.int64)
        for part, own in zip(self.bags, bits):
            if own:
                bag += np.bitwise_count(part & np.uint64(own))
        lengths = np.arange(self.length.max() + 1)
        grid = self.highest(n, nt, nd, np.arange(n + 1)[:, None], lengths, lengths, lengths, False, 0)
        special = shared.copy()
        special[self.odd] = True
        special = np.flatnonzero(special)
        special_high = self.highest(n, nt, nd, bag[special].astype(np.int64), self.length[special], self.turned_length[special], self.set_length[special], shared[special], held[special])
        is_special = np.zeros(len(self.names), bool)
        is_special[special] = True
        done = np.zeros(len(self.names), bool)
        for step in [x for x in STEPS if x > least + EPSILON] + [least]:
            need = (grid < step - EPSILON).sum(0)  # letters in common that a name of each length must have
            fair = np.flatnonzero((bag >= need.astype(bag.dtype)[self.length]) & ~is_special & (self.length > 0) & ~done)
            some = special_high >= step - EPSILON
            if step == floor:  # of equal scores, those behind the last of the k lower bounds are not wanted
                fair = fair[(self.first[fair] < last) | (bag[fair] >= (grid <= floor + EPSILON).sum(0)[self.length[fair]])]
                some &= (special_high > floor + EPSILON) | (self.first[special] <= last)
            fair = np.concatenate([fair, special[some & ~done[special]], seeds[~done[seeds] & ~is_special[seeds]] if step == floor else seeds[:0]])
            if len(fair):
                known += self.scored(query, turned, nd, k, step, fair, bag[fair].astype(np.int64), held[fair], shared[fair], [s for s, _ in known])
                known.sort(key=lambda x: (-x[0], self.first[x[1]]))
                known = known[:k]
                done[[i for _, i in known]] = True
            if len(known) == k and step > least:  # all of this score or more are known
                break
        return [x for x in known[:k] if x[0] >= cutoff]

    @staticmethod
    def lowest(n: int, nd: int, held: np.ndarray, m: np.ndarray, md: np.ndarray) -> np.ndarray:
        """A lower bound of the score, by words in common."""
        longer = np.maximum(n, m) / np.minimum(n, m)
        return np.where(longer < 1.5, 190.0 * held / (held + np.minimum(nd, md)), np.where(longer <= 8, 95.0 * 0.9, 95.0 * 0.6))

    @staticmethod
    def highest(n: int, nt: int, nd: int, bag: np.ndarray, m: np.ndarray, mt: np.ndarray, md: np.ndarray, shared, held) -> np.ndarray:
        """An upper bound of the score, by letters and words in common."""
        one = np.maximum
        less, least_t, least_d = np.minimum(n, m), np.minimum(nt, mt), np.minimum(nd, md)
        longer = np.maximum(n, m) / one(1, less)
        whole = one(200.0 * bag / (n + m), 190.0 * bag / (nt + mt))
        sets = one(190.0 * np.minimum(bag, least_d) / (nd + md), np.where(shared, 190.0 * held / one(1, held + least_d), 0.0))
        part = lambda l: 200.0 * np.minimum(bag, l) / one(1, l + np.minimum(bag, l))
        parts = one(part(less), np.where(shared, 95.0, 0.95 * one(part(least_t), part(least_d))))
        return one(whole, np.where(longer < 1.5, sets, np.where(longer <= 8, 0.9, 0.6) * parts))

    def scored(self, query: str, turned: str, nd: int, k: int, cutoff: float, fair: np.ndarray, bag: np.ndarray, held: np.ndarray, shared: np.ndarray, known: list[float]) -> list[tuple[float, int]]:
        """(score, index) of the names numbered `fair` that have `cutoff` or more and can be among the k best with those of the scores `known`."""
        n, nt = len(query), len(turned)
        m, mt, md = self.length[fair], self.turned_length[fair], self.set_length[fair]
        c1 = self.common(self.plain, query, [self.names[i] for i in fair], fair)
        c2 = self.common(self.turned, turned, [self.turned_names[i] for i in fair], fair)
        one = np.maximum
        less, least_t, least_d = np.minimum(n, m), np.minimum(nt, mt), np.minimum(nd, md)
        longer = one(n, m) / less
        near, scale = longer < 1.5, np.where(longer <= 8, 0.9, 0.6)
        ratio = 200.0 * c1 / (n + m)
        low = one(ratio, np.where(near, 190.0 * c2 / (nt + mt), 0.0))
        low = np.where(shared, one(low, self.lowest(n, nd, held, m, md)), low)
        part = lambda c, l: 200.0 * c / one(1, l + c)
        sets = 190.0 * np.minimum(np.where(shared, bag, c2), least_d) / (nd + md)
        parts = scale * one(part(c1, less), np.where(shared, 0.0, 0.95 * one(part(c2, least_t), part(np.minimum(c2, least_d), least_d))))
        high = one(low, np.where(near, sets, parts))
        every = np.append(low, known)
        least = max(cutoff, np.partition(every, -k)[-k] if len(every) >= k else 0.0) - EPSILON
        score, left = low.copy(), np.flatnonzero((high >= least) & (high > low + 1e-9))
        left, size, twice = left[np.argsort(-high[left], kind="stable")], 64, (md < mt) | (nd < nt)
        while len(left):  # the highest bounds first, as their scores settle the others
            some, left, size = left[:size], left[size:], 2 * size
            for i in some[near[some]]:
                score[i] = weighted_ratio(query, self.names[fair[i]])
            far = some[~near[some]]
            apart = far[~shared[far]]
            for rows, text, others, share in ((far, query, self.names, 1.0), (apart, turned, self.turned_names, 0.95)):
                if len(rows):
                    score[rows] = one(score[rows], share * scale[rows] * partial_ratios(text, [others[fair[i]] for i in rows], least / share / scale[rows] - EPSILON))
            if len(rows := apart[twice[apart]]):  # words that stand twice count once
                score[rows] = one(score[rows], 0.95 * scale[rows] * partial_ratios(" ".join(sorted(set(query.split()))), [" ".join(sorted(set(self.names[fair[i]].split()))) for i in rows]))
            every = np.append(score, known)
            least = max(least, np.partition(every, -k)[-k] - EPSILON if len(every) >= k else 0.0)
            left = left[high[left] >= least]
        score = np.round(score, 6)
        kept = np.flatnonzero((high >= least) & (score >= cutoff - EPSILON / 2))
        kept = kept[np.lexsort((self.first[fair[kept]], -score[kept]))][:k]
        return [(float(score[i]), int(fair[i])) for i in kept]


def partial_ratios(query: str, names: list[str], least: np.ndarray | None = None) -> np.ndarray:
    """similarity.partial_ratio() of `query` with each name, counted for all stretches of all names at once; under `least` what is known of it."""
    out, need = np.zeros(len(names)), np.zeros(len(names)) if least is None else least
    pairs = [(i, *((query, t) if len(query) <= len(t) else (t, query))) for i, t in enumerate(names)]
    for i, a, b in pairs:
        if len(a) > BITS or not a:
            out[i] = partial_ratio(a, b)
    pairs = sorted((x for x in pairs if 0 < len(x[1]) <= BITS), key=lambda x: (len(x[1]), len(x[2])))
    for begin in range(0, len(pairs), 256):
        some = pairs[begin : begin + 256]
        at, short, long = np.array([x[0] for x in some]), [x[1] for x in some], [x[2] for x in some]
        n = np.array([len(a) for a in short])
        most, width = int(n.max()), max(map(len, long))
        kind = np.uint32 if most <= 32 else np.uint64
        best = np.zeros(len(some))

        def places(a: list[str], b: list[str], most: int = most, width: int = width, kind: type = kind) -> np.ndarray:
            """For each letter of b the bits of its places in a; none behind its end."""
            own = np.array(a, f"<U{most}").view(np.uint32).reshape(len(a), most)
            own[own == 0] = 0x110000
            other = np.array(b, f"<U{width}").view(np.uint32).reshape(len(b), width)
            bits = np.zeros((len(a), width + 3 * most), kind)
            for i in range(most):
                bits[:, :width] |= (own[:, i : i + 1] == other) * kind(1 << i)
            return bits

        def held(bits: np.ndarray, n: np.ndarray, starts: np.ndarray, length: int, kind: type = kind) -> np.ndarray:
            """The longest common subsequence with a stretch of n + `length` letters from each of `starts`, the best of them."""
            row = np.full((len(bits), len(starts)), ~kind(0))
            for j in range(int(n.max()) + length):
                column = bits[:, starts + j]
                hit = row & (column if j < n.min() + length else column * (j < n + length)[:, None])
                row = (row + hit) | (row - hit)
            return np.bitwise_count(~row).max(1)

        inner = places(short, long)
        for bits in (inner, places([a[::-1] for a in short], [b[::-1] for b in long])):  # stretches over the ends
            row = np.full(len(some), ~kind(0))
            for j in range(most - 1):
                hit = row & bits[:, j]
                row = (row + hit) | (row - hit)
                best = np.where(j + 1 < n, np.maximum(best, 200.0 * np.bitwise_count(~row) / (n + j + 1)), best)
        # longer stretches that hold all others tell which names can reach the least that counts
        count, step = width - int(n.min()) + 1, max(1, most // 3)
        open_to = np.arange(len(some))
        if count > 2 * step and need[at].any():
            open_to = np.flatnonzero(np.maximum(best, 100.0 * held(inner, n, np.arange(0, count, step), step) / n) >= need[at])
        if len(open_to):
            best[open_to] = np.maximum(best[open_to], 100.0 * held(inner[open_to], n[open_to], np.arange(count), 0) / n[open_to])
        out[at] = best
    return out


def cut(rows: DataFrame, size: int, *columns: str) -> DataFrame:
    """group and the columns as lists, in blocks of about `size` rows; blocks go by hash, counted per group before."""
    counts = small_side(rows.groupBy("group").agg(F.ceil(F.count("*") / size).alias("_n")))
    return rows.join(counts, "group").groupBy("group", F.pmod(F.xxhash64(columns[0]), F.col("_n")).alias("_block")).agg(F.collect_list(F.struct(*columns)).alias("rows")).select("group", *[F.col(f"rows.{c}").alias(c) for c in columns])


def nearest(queries: DataFrame, targets: DataFrame, k: int = 1, cutoff: float = 0.0) -> DataFrame:
    """group, normal, m_normal, first, score: the k most similar names for each queried name of a group.

    queries: group, normal; targets: group, m_normal, first (the place of the name in its table); rows of either may
    repeat. Of equal scores those with the least `first` stay, of equal names the least `first`. Null and empty
    names have no neighbours; queries without any of score `cutoff` or more give no row.
    """
    asked = durable(queries.where("normal <> ''").select("group", "normal").distinct())
    known = targets.where("m_normal <> ''").join(asked.select("group").distinct(), "group", "left_semi").groupBy("group", "m_normal").agg(F.min("first").alias("first"))
    known = durable(known)
    blocks = shuffled(cut(asked, QUERIES, "normal")).join(shuffled(cut(known, TARGETS, "m_normal", "first")), "group")

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, block = None, None
        for batch in batches:
            out = []
            for group, names, others, first in zip(batch.group, batch.normal, batch.m_normal, batch["first"]):
                others, order = list(others), list(first)
                if len(names) * len(others) <= 16:  # too few to encode
                    reach = lambda q, t: cutoff <= 90 or 2 * max(len(q), len(t)) < 3 * min(len(q), len(t))  # noqa: E731 lengths apart by half give 90 at most
                    found = [(q, s, i) for q in names for i, t in enumerate(others) if reach(q, t) and (s := round(weighted_ratio(q, t), 6)) >= cutoff]
                else:
                    if last != (group, order):  # rows of one block of targets follow each other
                        last, block = (group, order), Block(others, order)
                    found = [(q, s, i) for q in names for s, i in block.best(q, k, cutoff)]
                out += [(group, q, others[i], order[i], s) for q, s, i in found]
            yield pd.DataFrame(out, columns=["group", "normal", "m_normal", "first", "score"])

    ranked = spread(blocks).sortWithinPartitions("group", F.get("first", F.lit(0))).mapInPandas(score, RESULT).withColumn("_rank", F.row_number().over(Window.partitionBy("group", "normal").orderBy(F.desc("score"), "first")))
    return ranked.where(F.col("_rank") <= k).drop("_rank")
