"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics are those that ``quality_rules.measure`` counts, counted here by one pass
of byte operations and numpy over each text (the tests hold both against each other).
Trees are grown on a bounded sample of labelled rows: each statistic is cut into at
most 64 bins at its quantiles, gradients are summed per node and bin, and each level
takes the best split of every node. All trees are flattened into five arrays, and
whole batches walk down all trees by array look-ups in numpy.

Defined cases: null and blank texts have statistics of zero and get a score like any
text; without labels every score is 0, with labels of one class its share of ones;
repeated rows are scored each; an empty table gives an empty result; only id and text
are read, other columns may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import BLANKS, id_remainder, utf8
from millrace.llm.labelled import label_sample, labelled_documents
from millrace.llm.quality_rules import STOP_WORDS, SYMBOLS, WINDOW

DIVISOR, HELD = 5, 0
THRESHOLD = 0.3
COUNTS = [
    "n_chars", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stop",
    "n_distinct", "n_upper", "n_digits", "n_marks", "n_stops", "n_bullets", "n_open",
]


def _repeated(words: list[bytes]) -> int:
    """Words covered by windows that occur twice or more in the text."""
    import numpy as np

    if len(words) <= WINDOW:
        return 0
    number = {}
    runs = np.array([number.setdefault(w, len(number)) for w in words], "i8")
    if len(number) == len(words):
        return 0
    # Runs of 2, 4 and 8 words get exact numbers from those of their halves.
    width = 1
    while width < WINDOW:
        runs = np.unique(runs[:-width] * len(words) + runs[width:], return_inverse=True)[1]
        width *= 2
    twice = np.bincount(runs)[runs] > 1
    edges = np.zeros(len(words) + 1, "i8")
    starts = np.flatnonzero(twice)
    edges[starts] += 1
    edges[starts + WINDOW] -= 1
    return int((np.cumsum(edges) > 0).sum())


def _counter():
    """``count(text)``: the ``COUNTS`` of one UTF-8 text."""
    import unicodedata

    every = lambda characters: characters.encode()
    blanks, symbols, plain = every(BLANKS), every(SYMBOLS), bytes(range(128))
    upper = bytes(range(65, 91))
    stop, known = set(STOP_WORDS), {}

    def is_stop(word: bytes) -> bool:
        found = known.get(word)
        if found is None:
            if len(known) > 500_000:
                known.clear()
            found = known[word] = word.rstrip(b".,").decode("utf-8", "replace").lower() in stop
        return found

    def is_open(line: bytes) -> bool:
        end = line.rstrip(b" ").decode("utf-8", "replace")
        # A pattern's end of line may stand before one last separator.
        end = end[:-1] if end[-1:] in ("\r", "\x85", "\u2028", "\u2029") else end
        return end.endswith(("...", "\u2026"))

    def count(text: bytes) -> list[int]:
        without = lambda characters: len(text) - len(text.translate(None, characters))
        wide = text.translate(None, plain).decode("utf-8", "replace")
        chars = without(plain) + len(wide)
        words, lines = text.split(), [x for x in text.split(b"\n") if x.strip()]
        return [
            chars, len(words), chars - without(blanks), without(symbols), len(lines), len(lines) - len(set(lines)), _repeated(words),
            sum(map(is_stop, words)), len(set(words)), without(upper) + sum(unicodedata.category(c) == "Lu" for c in wide),
            without(b"0123456789"), without(b"!?"), without(b".,"),
            sum(x.lstrip(b" ").startswith((b"- ", b"* ", every("\u2022 "))) for x in lines), sum(map(is_open, lines)),
        ]

    return count


def _counted():
    def run(batches):
        import numpy as np
        import pyarrow as pa

        count = _counter()
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                found = np.array([count(t) for t in utf8(part.columns[-1])], "i8").reshape(-1, len(COUNTS))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], *map(pa.array, found.T.copy())], names=[*part.schema.names[:-1], *COUNTS])

    return run


def counted(docs: DataFrame, keep: str) -> DataFrame:
    """The column ``keep`` and the ``COUNTS`` of every text."""
    kind = docs.schema[keep].dataType.simpleString()
    texts = docs.select(docs[keep], docs["text"].cast("string").alias("_text"))
    return texts.mapInArrow(_counted(), f"`{keep}` {kind}, {', '.join(f'{n} long' for n in COUNTS)}")


def statistics(counts):
    """Ratios of the counts, one row per document: what the trees see."""
    import numpy as np

    c = {n: np.asarray(counts[n], "f8") for n in COUNTS}
    words, chars, lines = (np.maximum(c[n], 1) for n in ("n_words", "word_chars", "n_lines"))
    return np.stack([
        np.log1p(c["n_words"]), c["word_chars"] / words, c["n_symbols"] / chars, c["n_dup_lines"] / lines,
        c["n_repeat_words"] / words, c["n_stop"] / words, c["n_distinct"] / words, c["n_upper"] / chars,
        c["n_digits"] / chars, c["n_marks"] / chars, c["n_stops"] / chars, c["n_bullets"] / lines,
        c["n_open"] / lines, words / lines,
    ], 1)


@dataclass
class Trees:
    """All trees in flat arrays: a node's statistic, bound, left child and value; the right child follows the left.

    A leaf is its own child, so every row can take the same number of steps.
    """

    start: float
    roots: object
    feature: object
    bound: object
    left: object
    value: object
    depth: int

    def score(self, x):
        import numpy as np

        total, rows = np.full(len(x), self.start), np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                down = self.left[node]
                node = np.where(down == node, node, down + (x[rows, self.feature[node]] > self.bound[node]))
            total += self.value[node]
        return 1 / (1 + np.exp(-np.clip(total, -60, 60)))


def fit_trees(x, y, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 64, ridge: float = 1.0, least: int = 5) -> Trees:
    """Boosted trees for the log-odds of y = 1, grown level by level from histograms."""
    import numpy as np

    share = y.mean()
    start = float(np.log(share / (1 - share)))
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], 1)
    total = np.full(len(x), start)
    feature, bound, left, value, roots = [], [], [], [], []

    def add(leaf_value):
        feature.append(0)
        bound.append(0.0)
        left.append(len(left))
        value.append(leaf_value)
        return len(left) - 1

    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        slope, bend = y - p, p * (1 - p)
        roots.append(add(rate * slope.sum() / (bend.sum() + ridge)))
        node = np.full(len(x), roots[-1])
        level = [roots[-1]]
        for _ in range(depth):
            place = {n: i for i, n in enumerate(level)}
            where = np.array([place.get(n, -1) for n in range(len(left))])[node]
            live = where >= 0
            best = [(1e-6, None)] * len(level)
            for j, c in enumerate(cuts):
                if not len(c):
                    continue
                width = len(c) + 1
                cell = where[live] * width + binned[live, j]
                sums = [np.bincount(cell, w, len(level) * width).reshape(-1, width).cumsum(1) for w in (slope[live], bend[live], None)]
                g, h, n = (s[:, :-1] for s in sums)
                gt, ht, nt = (s[:, -1:] for s in sums)
                gain = g**2 / (h + ridge) + (gt - g) ** 2 / (ht - h + ridge) - gt**2 / (ht + ridge)
                gain[(n < least) | (nt - n < least)] = 0
                for i, k in enumerate(gain.argmax(1)):
                    if gain[i, k] > best[i][0]:
                        best[i] = (gain[i, k], (j, k, [(g[i, k], h[i, k]), (gt[i, 0] - g[i, k], ht[i, 0] - h[i, k])]))
            following = []
            for n, (_, split) in zip(level, best):
                if split:
                    j, k, sides = split
                    children = [add(rate * g / (h + ridge)) for g, h in sides]
                    feature[n], bound[n], left[n] = j, float(cuts[j][k]), children[0]
                    own = node == n
                    node[own] = children[0] + (x[own, j] > cuts[j][k])
                    following += children
            level = following
            if not level:
                break
        total += np.array(value)[node]
    return Trees(start, np.array(roots), np.array(feature), np.array(bound), np.array(left), np.array(value), depth)


def fit(docs: DataFrame, labels: DataFrame, bound: int = 20_000) -> Trees | float:
    """The trees, or the share of ones where the labels do not hold both classes."""
    import numpy as np

    rows = labelled_documents(docs.select("doc_id", "text"), label_sample(labels, "quality", DIVISOR, HELD, bound))
    # An id may stand in several rows; of these, too, ``bound`` are taken by hash.
    found = counted(rows, "_label").orderBy(F.xxhash64("_label", *COUNTS), "_label", *COUNTS).limit(bound).toPandas()
    y = found["_label"].to_numpy("f8")
    if not len(y) or y.min() == y.max():
        return float(y.mean()) if len(y) else 0.0
    order = np.lexsort([found[n].to_numpy() for n in COUNTS])  # the same rows in any order give the same trees
    return fit_trees(statistics(found)[order], y[order])


def _scored(model):
    counted = _counted()

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in counted(batches):
            x = statistics({n: batch.column(n).to_numpy() for n in COUNTS})
            score = np.full(len(x), model) if isinstance(model, float) else model.score(x)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    return run


def score(docs: DataFrame, model) -> DataFrame:
    """``doc_id`` and ``score`` of every document."""
    texts = docs.select("doc_id", docs["text"].cast("string").alias("_text"))
    return texts.mapInArrow(_scored(model), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def query(spark, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Quality score of every document by boosted trees over its statistics."""
    return score(docs, fit(docs, labels)).select(
        "doc_id", (id_remainder("doc_id", DIVISOR) == HELD).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
