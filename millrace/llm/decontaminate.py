"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

The test items are a query set, taken in blocks of bounded size; each block goes to
all tasks and meets all documents. One pass over the texts keeps, of documents that
hold any n-gram of the block, where it stands. Document counts of these n-grams over
the whole corpus then tell each item's rare n-grams, its seeds, from phrases of the
language; rare is meant against the item's own median. An item's common n-grams may
owe their count to its own leaks, so they are seeds as well wherever the words round
them could reach the threshold in the best of orders; only passages that cannot are
left out, and no document is lost by how often its n-grams occur.
Passages round the seeds are aligned with the item, word by word, and the best local
score over the score of the whole item tells copies, edited or paraphrased ones too.

A document yields at most one row per item. Windows reach one item's length beyond the
seeds, and seeds closer than that share a window, so long texts cost what they hold.

Defined cases: null and blank texts and items match nothing; items of fewer words than
an n-gram are too short to show a leak and match nothing; repeated items and rows are
compared each; item ids may be of any type; empty tables give an empty result; only id and text are read, and the
stage keeps whatever columns there are.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from millrace.llm.common import with_place
from millrace.session import materialize

N = 4
THRESHOLD = 0.5
MATCH, MISMATCH, GAP = 2, -1, 1


def words_of(text: str | None) -> list[str]:
    import re

    return re.findall(r"\w+", text.lower()) if text else []


def _grams(ids):
    """A 64-bit number for every run of N word ids; 0 where a word is unknown."""
    import numpy as np

    if len(ids) < N:
        return np.zeros(0, "u8")
    out, known = np.zeros(len(ids) - N + 1, "u8"), np.ones(len(ids) - N + 1, bool)
    for i in range(N):
        part = ids[i : len(ids) - N + 1 + i].astype("u8")
        out = (out ^ part) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
        known &= part > 0
    return np.where(known, out, np.uint64(0))


class Block:
    """A block of items: their words as ids, and where each n-gram stands."""

    def __init__(self, items: list[tuple]):
        import numpy as np

        self.vocabulary: dict[str, int] = {}
        self.ids, self.words, places = [], [], []
        for item, text in items:
            words = words_of(text)
            if len(words) < N:
                continue
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], "i4")
            grams = _grams(ids)
            places += [(g, len(self.ids), at) for at, g in enumerate(grams.tolist())]
            self.ids.append(item)
            self.words.append(ids)
        places.sort()
        self.keys = np.unique(np.array([x[0] for x in places], "u8"))
        self.gram = np.searchsorted(self.keys, np.array([x[0] for x in places], "u8"))
        self.item = np.array([x[1] for x in places], "i8")
        self.at = np.array([x[2] for x in places], "i8")

    def find(self, grams):
        """(positions, n-gram numbers) of those in the block."""
        import numpy as np

        own = np.flatnonzero(grams)
        if not len(own) or not len(self.keys):
            return own[:0], own[:0]
        number = np.searchsorted(self.keys, grams[own])
        hit = self.keys[np.minimum(number, len(self.keys) - 1)] == grams[own]
        return own[hit], number[hit]


def _occurrences(block: Block):
    """Of texts that hold an n-gram of the block: word ids, positions and numbers of the n-grams."""

    def run(batches):
        from itertools import repeat

        import numpy as np
        import pyarrow as pa

        known = block.vocabulary.get
        for batch in batches:
            rows, ids, places, grams = [], [], [], []
            for row, text in enumerate(batch.columns[-1].to_pylist()):
                words = words_of(text)
                own = np.fromiter(map(known, words, repeat(0)), "i4", len(words))
                at, number = block.find(_grams(own))
                if len(at):
                    rows.append(row)
                    ids.append(own)
                    places.append(at.astype("i4"))
                    grams.append(number.astype("i4"))
            taken = [c.take(pa.array(rows, "i8")) for c in batch.columns[:-1]]
            lists = [pa.array(x, pa.list_(pa.int32())) for x in (ids, places, grams)]
            yield pa.RecordBatch.from_arrays([*taken, *lists], names=[*batch.schema.names[:-1], "_ids", "_at", "_grams"])

    return run


def choose_seeds(block: Block, seen: dict[int, int], times: int = 8, least: int = 4):
    """For each item its rare n-grams, as a mask over the block's places.

    Rare is what occurs in at most ``times`` as many documents as the item's median
    n-gram, of those that occur at all. The ``least`` rarest always stay. The others are
    looked at too, see :func:`_aligned`, but only where enough of the item's words meet.
    """
    import numpy as np

    count = np.array([seen.get(g, 0) for g in block.gram.tolist()], "i8")
    keep = np.zeros(len(count), bool)
    order = np.lexsort([block.at, count, block.item])
    order = order[count[order] > 0]
    for own in np.split(order, np.flatnonzero(np.diff(block.item[order])) + 1):
        if len(own):
            keep[own] = (count[own] <= times * np.median(count[own])) | (np.arange(len(own)) < least)
    return keep


def align(items, passages):
    """Best local alignment scores of pairs of word id arrays: match 2, mismatch -1, gap -1.

    Rows of the score matrix are filled for all pairs at once; within a row, gaps
    along the passage are a running maximum. Word id 0 (unknown) matches nothing.
    """
    import numpy as np

    n, m = max(map(len, items)), max(map(len, passages))
    a, b = np.full((len(items), n), -1, "i4"), np.zeros((len(items), m), "i4")
    for i, (x, y) in enumerate(zip(items, passages)):
        a[i, : len(x)], b[i, : len(y)] = x, y
    slide = GAP * np.arange(m, dtype="i4")
    above, best = np.zeros((len(items), m), "i4"), np.zeros(len(items), "i4")
    for i in range(n):
        diagonal = np.zeros_like(above)
        diagonal[:, 1:] = above[:, :-1]
        now = np.maximum(diagonal + np.where(b == a[:, i : i + 1], MATCH, MISMATCH), above - GAP)
        now = np.maximum(now, 0)
        now = np.maximum(np.maximum.accumulate(now + slide, axis=1) - slide, 0)
        best = np.maximum(best, now.max(1))
        above = now
    return best


def _aligned(block: Block, keep, kind):
    """Rows of (kept columns, item, score, first and last word of the best passage)."""
    import numpy as np

    order = np.argsort(block.gram, kind="stable")
    gram, item, at, rare = block.gram[order], block.item[order], block.at[order], keep[order]
    bags = [np.unique(words, return_counts=True) for words in block.words]

    def enough(i, passage):
        """Whether the words that item and passage share, in any order, could reach the threshold."""
        words, times = bags[i]
        place = np.minimum(np.searchsorted(words, passage), len(words) - 1)
        shared = np.bincount(place[words[place] == passage], minlength=len(words))
        return np.minimum(shared, times).sum() >= THRESHOLD * len(block.words[i])

    def windows(ids, places, grams):
        """(item, passage start, passage end) round the seeds of one text."""
        low, high = np.searchsorted(gram, grams, "left"), np.searchsorted(gram, grams, "right")
        times = high - low
        if not times.sum():
            return []
        spot = np.repeat(low - np.r_[0, times.cumsum()[:-1]], times) + np.arange(times.sum())
        # Where the item would start in the text.
        who, begins = item[spot], np.repeat(places, times) - at[spot]
        by = np.lexsort([begins, who])
        who, begins = who[by], begins[by]
        seeds = np.r_[0, np.cumsum(rare[spot[by]])]
        size = np.array([len(block.words[i]) for i in who])
        new = np.r_[True, (who[1:] != who[:-1]) | (begins[1:] - begins[:-1] > size[1:])]
        firsts = np.flatnonzero(new)
        lasts = np.r_[firsts[1:] - 1, len(who) - 1]
        found = [(int(who[f]), max(0, int(begins[f] - size[f] // 2)), min(len(ids), int(begins[e] + 2 * size[f])))
                 for f, e in zip(firsts, lasts)]
        sure = seeds[lasts + 1] > seeds[firsts]
        return [(i, a, b) for (i, a, b), seed in zip(found, sure) if seed or enough(i, ids[a:b])]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            ids, places, grams = (batch.column(batch.schema.get_field_index(n)) for n in ("_ids", "_at", "_grams"))
            pairs, best = [], {}
            for row in range(batch.num_rows):
                own = ids[row].values.to_numpy()
                pairs += [(row, i, a, b, own[a:b]) for i, a, b in windows(own, places[row].values.to_numpy(), grams[row].values.to_numpy())]
            pairs.sort(key=lambda x: len(x[4]))
            start = 0
            while start < len(pairs):
                # As many pairs of about equal length at once as fill a few MB.
                take = max(1, min(512, (1 << 20) // max(1, len(pairs[min(start + 511, len(pairs) - 1)][4]))))
                part = pairs[start : start + take]
                start += take
                for (row, i, a, b, _), score in zip(part, align([block.words[x[1]] for x in part], [x[4] for x in part]).tolist()):
                    share = score / (MATCH * len(block.words[i]))
                    if share >= THRESHOLD and share > best.get((row, i), (0,))[0]:
                        best[row, i] = (share, a, b)
            keys = sorted(best)
            columns = [c.take(pa.array([k[0] for k in keys], "i8")) for c in batch.columns[:-3]]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array([block.ids[k[1]] for k in keys], kind), pa.array([best[k][0] for k in keys], "f8"),
                 pa.array([best[k][1] for k in keys], "i8"), pa.array([best[k][2] for k in keys], "i8")],
                names=[*batch.schema.names[:-3], "item_id", "score", "first_word", "end_word"])

    return run


def _columns(df: DataFrame, keep: list[str]) -> str:
    return ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keep)


def leaks(docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None, block_bytes: int = 4 << 20) -> DataFrame:
    """``keep`` (``doc_id``), ``item_id``, ``score`` and passage of every document and item that align well."""
    keep = keep or ["doc_id"]
    spark = docs.sparkSession
    items = benchmark.select("item_id", F.col("text").cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    narrow = docs.select(*keep, docs["text"].cast("string").alias("_text"))
    kept = _columns(docs, keep)
    out = spark.createDataFrame([], f"{kept}, item_id {items.schema['item_id'].dataType.simpleString()}, score double, first_word long, end_word long")
    for number in range(blocks):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number)
        block = Block(sorted(((r[0], r[1]) for r in own.collect()), key=str))
        if not block.ids:
            continue
        held = materialize(
            narrow.mapInArrow(_occurrences(block), f"{kept}, _ids array<int>, _at array<int>, _grams array<int>"), "occurrences")
        counted = held.select(F.explode(F.array_distinct("_grams")).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))
        seeds = choose_seeds(block, {r["gram"]: r["n"] for r in counted.collect()})
        found = held.mapInArrow(_aligned(block, seeds, to_arrow_type(items.schema["item_id"].dataType)), out.schema)
        out = out.unionByName(found) if blocks > 1 else found
    return out


def query(spark, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents with a passage that aligns with a benchmark item, and the score."""
    return leaks(docs, benchmark)


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without any benchmark passage."""
    placed, place = with_place(docs)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = materialize(leaks(placed, benchmark, [place]).select(place).distinct(), "leaks")
    return placed.join(found, place, "left_anti").select(*[placed[c] for c in docs.columns])
