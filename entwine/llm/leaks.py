"""Evaluation passages inside training text (problem 8).

Each item is cut into pieces so short that a passage with its budget of edits holds at least one piece
unchanged; one scan of a text by an automaton of all pieces finds every such hit. Hits along one diagonal
make a passage, whose distance to the item's words a bit-parallel edit distance measures. A passage counts by
what it holds of the item's words weighted by rarity, so wording common to many texts proves nothing. Copies and
near copies of a text, found by bands of min-hashes, count as one text there, so a leak does not become common by
being copied.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from math import log
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entwine.llm.copies import mix
from entwine.llm.words import plain
from entwine.plans.durable import durable, spread

#: Words of a piece. With one edit in RATE words, of any 2 * PIECE - 1 consecutive words at least one piece is whole.
PIECE = 4
#: Share of the item's words that must be in the text, and of their rarity-weighted sum in the passage found.
HALF, WEIGHT = 0.5, 0.6
#: Share of all texts up to which a word is rare, weight of other words, and share of the item's weight that whole pieces must hold.
RARE, STOCK, SIGN = 0.005, 0.1, 0.15
#: Passages of an item in one text that may be put together, and the shift between hits that an edit may cause.
PARTS, SHIFT = 2, 4
#: Words of a shingle, bands of a text's signature, min-hashes of a band. Near copies with four fifths of their shingles in common share a band nearly always.
SHINGLE, BANDS, ROWS = 4, 8, 4
SEEDS = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64))
#: Characters of items searched in one pass; a larger set of items goes through the corpus in several passes.
BLOCK_CHARS = 32_000_000
WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall(plain(text)) if text else []


def signature(words: list[str]) -> list[int]:
    """BANDS keys of the shingles of a text; near copies have at least one in common."""
    codes = np.fromiter((crc32(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words))
    n = max(1, len(codes) - SHINGLE + 1)
    shingles = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(min(SHINGLE, len(codes))):
            shingles = mix(shingles + codes[k : k + n] + np.uint64(k))
        least = np.full(len(SEEDS), 2**64 - 1, np.uint64)
        for at in range(0, n, 10_000):
            least = np.minimum(least, mix(shingles[at : at + 10_000, None] ^ SEEDS).min(0))
        keys = np.arange(BANDS, dtype=np.uint64)
        for row in least.reshape(ROWS, BANDS):
            keys = mix(keys + row)
    return keys.view(np.int64).tolist()


def distance(pattern: list[str], text: list[str]) -> int:
    """Least edits between the whole of `pattern` and any stretch of `text`, by Myers' bit-parallel columns over words."""
    m = len(pattern)
    if not m:
        return 0
    masks: dict[str, int] = {}
    for i, w in enumerate(pattern):
        masks[w] = masks.get(w, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best = score
    for w in text:
        eq = masks.get(w, 0)
        vertical = eq | down
        diagonal = (((eq & up) + up) ^ up) | eq
        plus, minus = down | (~(diagonal | up) & full), up & diagonal
        score += bool(plus & top) - bool(minus & top)
        plus, minus = plus << 1 & full, minus << 1 & full
        up, down = minus | (~(vertical | plus) & full), plus & vertical
        best = min(best, score)
    return best


class Items:
    """The items of one block with the automaton of their pieces."""

    def __init__(self, rows: list[tuple[int, str]], rarity: dict[str, float]):
        import ahocorasick

        self.words = {k: words_of(t) for k, t in rows}
        self.rarity = rarity
        self.weight = {k: sum(rarity.get(w, 0.0) for w in ws) for k, ws in self.words.items()}
        self.vocabulary = {w for ws in self.words.values() for w in ws}
        places: dict[str, list[tuple[int, int]]] = {}
        for k, ws in self.words.items():
            for at in range(0, max(1, len(ws) - PIECE + 1), PIECE):
                if piece := ws[at : at + PIECE]:
                    places.setdefault(" " + " ".join(piece) + " ", []).append((k, at))
        self.automaton = ahocorasick.Automaton()
        for text, found in places.items():
            self.automaton.add_word(text, (text.count(" ") - 1, found))
        if places:
            self.automaton.make_automaton()

    def leaked(self, text: str | None) -> list[tuple[int, float]]:
        """(item, share of its words) for each item that has leaked into `text`."""
        words = words_of(text)
        if not words or not len(self.automaton):
            return []
        starts, at = [], 0
        for w in words:
            starts.append(at)
            at += len(w) + 1
        hits: dict[int, list[tuple[int, int, int]]] = {}
        for end, (size, found) in self.automaton.iter(" " + " ".join(words) + " "):
            place = bisect_right(starts, end - 1) - size  # the blank at `end` follows the piece's last word
            for item, pos in found:
                hits.setdefault(item, []).append((pos, place, size))
        return [(item, share) for item, own in hits.items() if (share := self.share(item, own, words)) is not None]

    def share(self, item: int, hits: list[tuple[int, int, int]], words: list[str]) -> float | None:
        ws = self.words[item]
        need = HALF * len(ws) - 1
        pieces = {p: n for p, _, n in hits}
        if len(pieces) * PIECE < need * 0.3 or sum(self.rarity.get(w, 0.0) for p, n in pieces.items() for w in ws[p : p + n]) < SIGN * self.weight[item]:
            return None  # fewer whole pieces than the budget of edits leaves, or stock wording only
        hits.sort(key=lambda x: (x[1], x[0]))
        chains: list[list[tuple[int, int, int]]] = []
        for hit in hits:
            best = None
            for chain in chains:
                p, d, n = chain[-1]
                if hit[0] > p and hit[1] > d and abs((hit[1] - hit[0]) - (d - p)) <= SHIFT and hit[0] - p <= 6 * PIECE and (best is None or len(chain) > len(best)):
                    best = chain
            if best is None:
                chains.append([hit])
            else:
                best.append(hit)
        parts = []
        for chain in chains:
            i0, d0 = chain[0][:2]
            i1, d1 = chain[-1][0] + chain[-1][2], chain[-1][1] + chain[-1][2]
            i0, d0 = self.extend(ws, words, i0 - 1, d0 - 1, -1)
            i1, d1 = self.extend(ws, words, i1, d1, 1)
            i0, d0 = i0 + 1, d0 + 1
            edits = distance(ws[i0:i1], words[max(0, d0) : d1])
            weight = sum(self.rarity.get(w, 0.0) for w in ws[i0:i1])
            here = Counter(words[max(0, d0) : d1])
            held = sum(self.rarity.get(w, 0.0) * min(n, here[w]) for w, n in Counter(ws[i0:i1]).items())
            if edits <= 0.4 * (i1 - i0):
                parts.append((i1 - i0 - edits, i0, i1, d0, d1, weight, held))
        parts.sort(reverse=True)
        best = None
        for a, one in enumerate(parts):
            if 2 * one[0] < need:
                break
            for two in [None, *parts[a + 1 :]]:
                if two and one[0] + two[0] < need:
                    break
                if two and not ((one[2] <= two[1] + 2 and one[4] <= two[3] + 2) or (two[2] <= one[1] + 2 and two[4] <= one[3] + 2)):
                    continue
                both = [one, two] if two else [one]
                got = sum(x[0] for x in both)
                if got >= need and sum(x[6] for x in both) >= WEIGHT * sum(x[5] for x in both) and (best is None or got > best):
                    best = got
        return best and min(1.0, best / len(ws))

    @staticmethod
    def extend(ws: list[str], words: list[str], i: int, d: int, step: int) -> tuple[int, int]:
        """Walk on while words agree; one word may be wrong, missing or added if the next two agree."""
        while 0 <= i < len(ws) and 0 <= d < len(words):
            if ws[i] == words[d]:
                i, d = i + step, d + step
                continue
            for di, dd in ((1, 1), (1, 0), (0, 1)):
                x, y = i + step * di, d + step * dd
                if 0 <= x < len(ws) and 0 <= y < len(words) and 0 <= x + step < len(ws) and 0 <= y + step < len(words) and ws[x] == words[y] and ws[x + step] == words[y + step]:
                    i, d = x, y
                    break
            else:
                break
        return i, d


def blocks(items: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of at most BLOCK_CHARS characters; the items are the query set, held against all texts."""
    block, size = [], 0
    for row in items.where("text IS NOT NULL").toLocalIterator():
        if block and size + len(row.text) > BLOCK_CHARS:
            yield block
            block, size = [], 0
        block.append((row.item_id, row.text))
        size += len(row.text)
    if block:
        yield block


def leaks(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, share): items of which at least half is in the text, in order, in one or two pieces, lightly altered or not.

    documents: doc_id, text; items: item_id, text. Null and empty texts hold nothing; an empty item leaks nowhere.
    Rows of one doc_id are searched one by one and reported once with the largest share.
    """
    spark, found = documents.sparkSession, None
    texts = documents.select("doc_id", "text").where("text IS NOT NULL")
    distinct = texts.select("text").distinct()
    for block in blocks(items.select("item_id", "text")):
        vocabulary = frozenset(w for _, t in block for w in words_of(t))

        def hold(batches: Iterator[pd.DataFrame], vocabulary=vocabulary) -> Iterator[pd.DataFrame]:
            for batch in batches:
                words = [words_of(t) for t in batch.text]
                yield pd.DataFrame({"id": batch.id, "bands": [signature(ws) for ws in words], "words": [list(vocabulary.intersection(ws)) for ws in words]})

        held = durable(spread(distinct).select(F.xxhash64("text").alias("id"), "text").mapInPandas(hold, "id long, bands array<long>, words array<string>"))
        banded = held.select("id", F.explode("bands").alias("band"))
        weights = banded.join(banded.groupBy("band").agg(F.count("*").alias("n")), "band").groupBy("id").agg((1.0 / F.max("n")).alias("w"))
        weighed = durable(held.select("id", "words").join(weights, "id"))
        total = weighed.agg(F.coalesce(F.sum("w"), F.lit(0.0))).first()[0]
        counted = weighed.select(F.explode("words").alias("word"), "w").groupBy("word").agg(F.sum("w").alias("n")).collect()  # one row per word of the block
        often = {r.word: r.n for r in counted}
        rarity = {w: max(0.0, log((total + 1) / (often.get(w, 0) + 1))) * (1.0 if often.get(w, 0) <= RARE * total + 3 else STOCK) for w in vocabulary}
        shared = spark.sparkContext.broadcast((block, rarity))

        def search(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            ready = Items(*shared.value)
            for batch in batches:
                rows = [(d, item, share) for d, text in zip(batch.doc_id, batch.text) for item, share in ready.leaked(text)]
                yield pd.DataFrame(rows, columns=["doc_id", "item_id", "share"])

        part = spread(texts).mapInPandas(search, "doc_id long, item_id long, share double")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "doc_id long, item_id long, share double")
    return found.groupBy("doc_id", "item_id").agg(F.round(F.max("share"), 4).alias("share"))
