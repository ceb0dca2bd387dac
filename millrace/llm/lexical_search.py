"""Ranked lexical search: an automaton of all item terms scans the texts; no index of the documents.

The items are a query set, taken in blocks of bounded size. A block's terms, each with
a blank on both sides as its boundary, make up one Aho-Corasick automaton. Texts are
brought to the form where every term stands between blanks; one scan of a text by the
automaton then counts all the block's terms in it. Each hit names a term, and a table in
the automaton's order of terms names its items.

Two scans of the corpus for a block: the first adds up the documents of each term and the
lengths, the second scores. A task keeps the best rows of each item only, so what it hands
on is bounded by items and ranks; the best of all tasks are ranked item by item.

Scores are whole numbers throughout, so the result does not depend on how rows are split.

Defined cases: null and blank texts have no terms and are counted nowhere; items
without terms, or whose terms no document holds, get no rows; repeated rows are
documents each, repeated items are ranked each; a null ``doc_id`` comes last among equal
scores; empty tables give an empty result. Only ids and texts are read, so other columns
may have any name.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import utf8, with_place
from millrace.session import materialize

BEST = 20
#: A block of items: bytes of text, and number of items.
BLOCK_BYTES, BLOCK_ITEMS = 2 << 20, 20_000
#: What no term holds becomes a blank, A-Z become small.
FORM = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(FORM).split()


class Block:
    """A block of items: its distinct terms, and for each term its items with its number of occurrences there."""

    def __init__(self, texts: list[bytes]):
        import numpy as np

        numbers, pairs = {}, {}
        for item, text in enumerate(texts):
            for term in terms_of(text):
                key = numbers.setdefault(term, len(numbers)), item
                pairs[key] = pairs.get(key, 0) + 1
        order = sorted(pairs)
        self.size, self.terms = len(texts), [t.decode() for t in numbers]
        self.starts = np.searchsorted([k[0] for k in order], np.arange(len(numbers) + 1)).astype("i8")
        self.items = np.array([k[1] for k in order], "i8")
        self.times = np.array([pairs[k] for k in order], "i8")

    def automaton(self):
        import ahocorasick

        made = ahocorasick.Automaton()
        for number, term in enumerate(self.terms):
            made.add_word(f" {term} ", number)
        made.make_automaton()
        return made


def _scan():
    """For each text: how many terms it has, and the block's terms with their counts; as a closure that ships by value."""
    from collections import Counter
    from operator import itemgetter

    def scan(automaton, texts):
        hit = itemgetter(1)
        for text in texts:
            form = text.translate(FORM)
            size = len(form.split())
            yield size, Counter(map(hit, automaton.iter(f" {form.decode('utf-8', 'replace')} "))) if size else {}

    return scan


def _statistics(block: Block):
    """(term, n): documents of each term; as term -1 the documents with terms, as -2 all terms."""
    scan = _scan()

    def run(batches):
        import numpy as np
        import pyarrow as pa

        automaton, held, docs, total = block.automaton(), np.zeros(len(block.terms), "i8"), 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for size, found in scan(automaton, utf8(batch.columns[0].slice(at, 256))):
                    docs, total = docs + (size > 0), total + size
                    if found:
                        held[list(found)] += 1
        seen = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[[-1, -2], seen]), pa.array(np.r_[[docs, total], held[seen]])], names=["term", "n"])

    return run


def _scores(block: Block, weights, documents: int, total: int, best: int):
    """(item, doc_id, score): the task's best documents of every item."""
    scan = _scan()
    # As many texts at a time as make about a million scores.
    step = max(1, min(256, (1 << 20) // max(1, block.size)))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        automaton = block.automaton()
        last = np.iinfo("i8").max
        floor, held = np.ones(block.size, "i8"), [np.zeros((4, 0), "i8")]

        def pruned():
            item, null, doc, score = np.concatenate(held, 1)
            order = np.lexsort((doc, null, -score, item))
            first = np.searchsorted(item[order], np.arange(block.size + 1))
            place = np.arange(len(order)) - first[item[order]]
            full = np.diff(first) >= best
            floor[full] = score[order[first[:-1][full] + best - 1]]
            return np.stack([item, null, doc, score])[:, order[place < best]]

        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                rows, terms, counts, bases = [], [], [], []
                for row, (size, found) in enumerate(scan(automaton, utf8(part.columns[1]))):
                    if found:
                        rows += [row] * len(found)
                        terms += found.keys()
                        counts += found.values()
                        bases += [100 - 25 + (25 * size * documents) // total] * len(found)
                if not rows:
                    continue
                rows, terms, counts, bases = (np.array(x, "i8") for x in (rows, terms, counts, bases))
                gains = weights[terms] * ((1_000_000_000 * counts) // (1000 * counts + 12 * bases))
                # Each hit goes to all items of its term.
                sizes = block.starts[terms + 1] - block.starts[terms]
                ends = np.cumsum(sizes)
                entry = np.arange(ends[-1]) + np.repeat(block.starts[terms] - (ends - sizes), sizes)
                table = np.zeros(part.num_rows * block.size, "i8")
                np.add.at(table, np.repeat(rows * block.size, sizes) + block.items[entry], np.repeat(gains, sizes) * block.times[entry])
                table = table.reshape(part.num_rows, block.size)
                row, item = np.nonzero(table >= floor)
                ids = part.columns[0]
                null = ids.is_null().to_numpy(zero_copy_only=False)
                doc = np.where(null, last, ids.fill_null(0).to_numpy())
                held.append(np.stack([item, null[row].astype("i8"), doc[row], table[row, item]]))
                if sum(h.shape[1] for h in held) > max(1 << 16, 2 * best * block.size):
                    held = [pruned()]
        item, null, doc, score = pruned()
        yield pa.RecordBatch.from_arrays(
            [pa.array(item), pa.array(doc, mask=null.astype(bool)), pa.array(score)], names=["item", "doc_id", "score"])

    return run


def search(docs: DataFrame, items: DataFrame, best: int = BEST, block_bytes: int = BLOCK_BYTES, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score`` of every item's ``best`` documents with a score above 0."""
    import numpy as np

    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType.simpleString()
    asked = items.select("item_id", F.coalesce(items["text"].cast("string"), F.lit("")).alias("text"))
    volume, count = asked.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    blocks = max(1, math.ceil((volume or 0) / block_bytes), math.ceil(count / block_items))
    # By place and not by content, so that repeated items spread over the blocks.
    asked, place = with_place(materialize(asked, "items"))
    texts = docs.select(docs["text"].cast("string").alias("text"))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    by_item = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    for number in range(blocks):
        own = asked.filter(F.pmod(F.xxhash64(place), F.lit(blocks)) == number).select("item_id", "text").toArrow()
        block = Block(utf8(own.column("text").combine_chunks()))
        if not block.terms:
            continue
        sums = texts.mapInArrow(_statistics(block), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
        found = {r["term"]: r["n"] for r in sums.collect()}
        documents, total = found.get(-1, 0), found.get(-2, 0)
        if not total:
            continue
        weights = np.array([
            math.floor(1000 * math.log((2 * documents + 2) / (2 * found.get(t, 0) + 1))) for t in range(len(block.terms))], "i8")
        scored = rows.mapInArrow(_scores(block, weights, documents, total, best), "item long, doc_id long, score long")
        ranked = scored.withColumn("rank", F.row_number().over(by_item)).filter(F.col("rank") <= best)
        names = spark.createDataFrame(list(enumerate(own.column("item_id").to_pylist())), f"item long, item_id {kind}")
        ranked = ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        out = out.unionByName(ranked) if blocks > 1 else ranked
    return out


def query(spark, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The 20 highest-scoring documents of every benchmark item."""
    return search(docs, benchmark)


def check_sql(best: int = BEST) -> str:
    """The same in DuckDB, by terms in rows."""
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    listed = f"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{pattern}')"
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS d, doc_id, {listed} AS terms FROM documents
), items AS (
  SELECT row_number() OVER () AS i, item_id, {listed} AS terms FROM benchmark
), sizes AS (
  SELECT CAST(count(*) FILTER (len(terms) > 0) AS BIGINT) AS n_all, CAST(sum(len(terms)) AS BIGINT) AS l_all FROM docs
), asked AS (
  SELECT i, term, CAST(count(*) AS BIGINT) AS times FROM (SELECT i, unnest(terms) AS term FROM items) GROUP BY i, term
), counts AS (
  SELECT d, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT d, unnest(terms) AS term FROM docs) WHERE term IN (SELECT term FROM asked) GROUP BY d, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(n_all) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM counts, sizes GROUP BY term
), gains AS (
  SELECT d, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * len(terms) * n_all) // l_all)))) AS gain
  FROM counts JOIN weights USING (term) JOIN docs USING (d), sizes
), scores AS (
  SELECT i, d, CAST(sum(times * gain) AS BIGINT) AS score FROM asked JOIN gains USING (term) GROUP BY i, d
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scores JOIN docs USING (d) JOIN items USING (i) WHERE score > 0) WHERE rank <= {best}"""
