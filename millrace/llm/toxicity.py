"""Toxicity by weak supervision: voters, a label model, a linear classifier.

1. A lexicon of words and word beginnings is mined from a bounded sample of labelled
   rows: those whose documents are toxic far more often than chance allows.
2. Every document is read once for how often, how densely and how strongly it holds
   entries of each kind; several voters (toxic, clean or no vote) look at each figure.
3. A generative label model estimates each voter's behaviour per class and the voters'
   correlations from the vote patterns of all documents outside the held-out part, by
   expectation maximisation that starts from the labelled sample. Correlated voters
   share their weight: a voter counts as 1 / (1 + its correlations with the others).
4. A linear classifier is trained on the model's posterior labels of a bounded sample
   and scores every document from the figures alone.

Vote patterns number at most 3^11 and are counted before they reach the driver;
lexicon and classifier are fitted on at most ``bound`` rows; all else covers all rows.

Defined cases: null and blank texts have no hits and get the score of a text without
any; without labels, or with labels of one class only, the lexicon is empty and every
score is the share of toxic labels (0 without labels); repeated rows are scored each;
an empty table gives an empty result; only id and text are read, and the stage keeps
whatever columns there are.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import id_remainder, utf8
from millrace.llm.labelled import label_sample, labelled_documents
from millrace.session import materialize

DIVISOR, HELD = 3, 1
THRESHOLD = 0.7
#: Whole words and word beginnings of so many letters.
KINDS = (0, 4, 5, 6, 7)
EDGE = ".,;:!?|#*$%&\"'()[]<>«»-_"
#: Per kind of entry: hits, different entries hit, summed log odds; then words.
FIGURES = [f"{n}{k}" for k in KINDS for n in ("hits", "kinds", "odds")] + ["n_words"]


def _entries(chunk: bytes) -> list[str]:
    """The whole word and its beginnings, each marked with its kind."""
    word = chunk.decode("utf-8", "replace").lower().strip(EDGE)
    if len(word) < 3:
        return []
    return [f"0{word}", *[f"{n}{word[:n]}" for n in KINDS[1:] if len(word) >= n]]


def _distinct(text: bytes) -> set[str]:
    return {e for c in set(text.split()) for e in _entries(c)}


def _mine(known: set[str] | None):
    """Documents per entry and label, summed in the task: of toxic documents, or of ``known`` entries in all."""

    def run(batches):
        from collections import Counter

        import pyarrow as pa

        def rows(counts):
            keys = list(counts)
            return pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], "string"), pa.array([k[1] for k in keys], "i4"),
                 pa.array([counts[k] for k in keys], "i8")], names=["entry", "label", "n"])

        counts = Counter()
        for batch in batches:
            for text, label in zip(utf8(batch.column(0)), batch.column(1).to_pylist()):
                if known is None and not label:
                    continue
                found = _distinct(text) if known is None else _distinct(text) & known
                counts.update((e, label) for e in found)
                if len(counts) > 200_000:
                    yield rows(counts)
                    counts.clear()
        yield rows(counts)

    return run


def mine_lexicon(rows: DataFrame, least_share: float = 0.005, least: int = 3, strength: float = 4.0) -> tuple[dict, float]:
    """Entries with their log odds, and the share of toxic rows, from ``text`` and ``_label``.

    An entry has to occur in a share of the toxic rows, which bounds the lexicon, and
    its signed root of the likelihood ratio has to reach ``strength``.
    """
    narrow = rows.select(rows["text"].cast("string").alias("text"), "_label")
    totals = {r["_label"]: r["n"] for r in rows.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    share = toxic / max(1, toxic + clean)
    if not toxic or not clean:
        return {}, share

    def counted(known):
        found = narrow.mapInArrow(_mine(known), "entry string, label int, n long")
        return found.groupBy("entry", "label").agg(F.sum("n").alias("n"))

    support = max(least, math.ceil(least_share * toxic))
    often = {r["entry"] for r in counted(None).filter(F.col("n") >= support).collect()}
    counts = {e: [0, 0] for e in often}
    for r in counted(often).collect():
        counts[r["entry"]][r["label"]] = r["n"]

    def term(seen, expected):
        return seen * math.log(seen / expected) if seen else 0.0

    lexicon = {}
    for entry, (n0, n1) in counts.items():
        p = (n0 + n1) / (toxic + clean)
        if n1 / toxic <= n0 / clean or p >= 1:
            continue
        ratio = 2 * (term(n1, toxic * p) + term(toxic - n1, toxic * (1 - p)) + term(n0, clean * p) + term(clean - n0, clean * (1 - p)))
        odds = math.log((n1 + 0.5) / (toxic - n1 + 0.5)) - math.log((n0 + 0.5) / (clean - n0 + 0.5))
        if math.sqrt(max(ratio, 0)) >= strength and odds >= 1.5:
            lexicon[entry] = odds
    return lexicon, share


class Reader:
    """Figures of texts against a lexicon, through a bounded memo of chunks."""

    def __init__(self, lexicon: dict[str, float], memo: int = 600_000):
        self.lexicon, self.limit, self.memo = lexicon, memo, {}

    def figures(self, texts: list[bytes]):
        import numpy as np

        out = np.zeros((len(texts), len(FIGURES)), "f8")
        memo, lexicon, slot = self.memo, self.lexicon, {str(k): 3 * i for i, k in enumerate(KINDS)}
        for row, text in enumerate(texts):
            chunks = text.split()
            out[row, -1] = len(chunks)
            if not lexicon:
                continue
            if len(memo) > self.limit:
                memo.clear()
            for chunk in set(chunks).difference(memo):
                memo[chunk] = [e for e in _entries(chunk) if e in lexicon] or ()
            seen = set()
            for entries in filter(None, map(memo.__getitem__, chunks)):
                for e in entries:
                    at = slot[e[0]]
                    out[row, at] += 1
                    if e not in seen:
                        seen.add(e)
                        out[row, at + 1] += 1
                        out[row, at + 2] += lexicon[e]
        return out


def measures(figures):
    """What the voters look at, one column each.

    One lexicon voter per kind of entry goes by summed log odds and one pattern voter
    per kind by the density of hits; the last one goes by the number of hits.
    """
    import numpy as np

    column = {n: figures[:, i] for i, n in enumerate(FIGURES)}
    words = np.maximum(column["n_words"], 1)
    hits = [column[f"hits{k}"] for k in KINDS]
    return np.stack([*[column[f"odds{k}"] for k in KINDS], *[h / words for h in hits], np.maximum.reduce(hits)], 1)


VOTERS = 2 * len(KINDS) + 1


def fit_voters(figures, labels, toxic: float = 0.9, clean: float = 0.99):
    """Per voter the least value that means toxic and the largest that means clean.

    From the labelled sample: at or above the first, a share ``toxic`` of the rows is
    toxic; at or below the second, a share ``clean`` is clean. In between there is no vote.
    """
    import numpy as np

    bounds = []
    for v in measures(figures).T:
        values = np.unique(v)
        ordered = np.sort(v)
        above = len(v) - np.searchsorted(ordered, values, "left")
        bad = np.sort(v[labels == 1])
        bad_above = len(bad) - np.searchsorted(bad, values, "left")
        good = values[(bad_above >= toxic * above) & (values > 0)]
        high = good.min() if len(good) else np.inf
        below = np.searchsorted(ordered, values, "right")
        bad_below = np.searchsorted(bad, values, "right")
        fine = values[((below - bad_below) >= clean * below) & (values < high)]
        bounds.append((max(fine.max(), 0.0) if len(fine) else 0.0, high))
    return np.array(bounds)


def votes(figures, bounds):
    """The votes (1 toxic, -1 clean, 0 none) of all voters on rows of figures."""
    import numpy as np

    seen = measures(figures)
    return np.where(seen >= bounds[:, 1], 1, np.where(seen <= bounds[:, 0], -1, 0)).astype("i8")


def _codes(table):
    """One number per vote pattern, in base three."""
    import numpy as np

    return ((table + 1) * 3 ** np.arange(VOTERS)).sum(1)


def _pattern(code):
    import numpy as np

    return np.array(code)[:, None] // 3 ** np.arange(VOTERS) % 3 - 1


@dataclass
class LabelModel:
    """Class share, vote probabilities per class and voter, voters' correlations and weights."""

    prior: float
    chances: object
    correlations: object
    weights: object

    def posterior(self, table):
        import numpy as np

        logs = np.zeros((len(table), 2))
        for y in (0, 1):
            for i in range(VOTERS):
                logs[:, y] += self.weights[i] * np.log(self.chances[y, i, table[:, i] + 1])
        gap = logs[:, 1] - logs[:, 0] + math.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(gap, -60, 60)))


def fit_label_model(table, counts, known_table, known_labels, rounds: int = 30) -> LabelModel:
    """Expectation maximisation over vote patterns and their counts; labelled rows start it and stay clamped."""
    import numpy as np

    def estimate(rows, weight_toxic, weight_clean):
        chances = np.ones((2, VOTERS, 3))
        for y, w in ((0, weight_clean), (1, weight_toxic)):
            for i in range(VOTERS):
                chances[y, i] += np.bincount(rows[:, i] + 1, weights=w, minlength=3)
        prior = (weight_toxic.sum() + 1) / (weight_toxic.sum() + weight_clean.sum() + 2)
        return prior, chances / chances.sum(2, keepdims=True)

    known = known_labels.astype("f8")
    prior, chances = estimate(known_table, known, 1 - known)
    model = LabelModel(prior, chances, np.eye(VOTERS), np.ones(VOTERS))
    rows = np.concatenate([table, known_table])
    for _ in range(rounds):
        # What is expected of a vote given the class leaves residuals; their correlation is the voters'.
        p = model.posterior(table)
        toxic = np.concatenate([p * counts, known])
        clean = np.concatenate([(1 - p) * counts, 1 - known])
        prior, chances = estimate(rows, toxic, clean)
        mean = chances @ np.array([-1.0, 0.0, 1.0])
        spread = np.zeros((VOTERS, VOTERS))
        for y, w in ((0, clean), (1, toxic)):
            rest = rows - mean[y]
            spread += (rest * w[:, None]).T @ rest
        scale = np.sqrt(np.maximum(np.diag(spread), 1e-9))
        related = np.clip(spread / scale[:, None] / scale, 0, 1)
        weights = 1 / related.sum(1).clip(1)
        model = LabelModel(prior, chances, related, weights)
    return model


def inputs(figures):
    """What the classifier sees of the figures."""
    import numpy as np

    words = np.maximum(figures[:, -1:], 1)
    out = []
    for i in range(len(KINDS)):
        hits, kinds, odds = (figures[:, 3 * i + j : 3 * i + j + 1] for j in range(3))
        out += [np.log1p(hits), np.log1p(kinds), np.minimum(odds, 30) / 10, np.minimum(hits / words, 0.1) * 10]
    return np.concatenate(out, 1)


def fit_linear(x, target, ridge: float = 1.0, rounds: int = 25):
    """Logistic regression on soft labels by Newton's method; weights with the intercept last."""
    import numpy as np

    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - target) + ridge * np.r_[w[:-1], 0]
        bend = (x * (p * (1 - p))[:, None]).T @ x + np.diag(np.r_[np.full(len(w) - 1, ridge), 1e-6])
        step = np.linalg.solve(bend, slope)
        w = w - step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class Classifier:
    """Lexicon and weights; with an empty lexicon every text scores ``share``."""

    lexicon: dict = field(default_factory=dict)
    weights: object = None
    share: float = 0.0

    def score(self, figures):
        import numpy as np

        if self.weights is None:
            return np.full(len(figures), self.share)
        x = inputs(figures)
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -60, 60)))


def _figures(lexicon, bounds):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        reader = Reader(lexicon)
        for batch in batches:
            found = reader.figures(utf8(batch.columns[-1]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *[pa.array(found[:, i].copy()) for i in range(len(FIGURES))],
                 pa.array(_codes(votes(found, bounds)) if bounds is not None else np.zeros(len(found), "i8"))], names=[*batch.schema.names[:-1], *FIGURES, "votes"])

    return run


def figures_of(df: DataFrame, keep: list[str], lexicon: dict, bounds=None) -> DataFrame:
    """The columns ``keep``, the figures of every text, and its vote pattern ``votes`` (0 without voters)."""
    narrow = df.select(*keep, df["text"].cast("string").alias("_text"))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[:-1]]
    return narrow.mapInArrow(_figures(lexicon, bounds), ", ".join([*kinds, *[f"{n} double" for n in FIGURES], "votes long"]))


def _matrix(rows):
    import numpy as np

    return np.array([[r[n] for n in FIGURES] for r in rows], "f8").reshape(-1, len(FIGURES))


def fit(docs: DataFrame, labels: DataFrame, bound: int = 20_000) -> Classifier:
    """Lexicon, label model and classifier; labels of the held-out part are never read."""
    import numpy as np

    rows = materialize(labelled_documents(docs.select("doc_id", "text"), label_sample(labels, "toxic", DIVISOR, HELD, bound)), "labelled")
    lexicon, share = mine_lexicon(rows)
    if not lexicon:
        return Classifier(share=share)
    known = figures_of(rows, ["_label"], lexicon).orderBy(F.xxhash64(*FIGURES)).limit(bound).collect()
    known_figures, known_labels = _matrix(known), np.array([r["_label"] for r in known])
    bounds = fit_voters(known_figures, known_labels)
    others = docs.select("doc_id", "text").filter(id_remainder("doc_id", DIVISOR) != HELD)
    stored = materialize(figures_of(others, ["doc_id"], lexicon, bounds), "figures")
    patterns = stored.groupBy("votes").agg(F.count("*").alias("n")).collect()
    model = fit_label_model(
        _pattern([r["votes"] for r in patterns]), np.array([r["n"] for r in patterns], "f8"),
        votes(known_figures, bounds), known_labels)
    size = sum(r["n"] for r in patterns)
    drawn = stored.filter(F.pmod(F.xxhash64(F.lit(5), "doc_id", *FIGURES), F.lit(1_000_000)) < F.lit(1_000_000 * min(1.0, bound / size)))
    sample = np.concatenate([known_figures, _matrix(drawn.select(*FIGURES).limit(2 * bound).collect())])
    return Classifier(lexicon, fit_linear(inputs(sample), model.posterior(votes(sample, bounds))), share)


def _scored(model: Classifier):
    def run(batches):
        import pyarrow as pa

        reader = Reader(model.lexicon)
        for batch in batches:
            score = model.score(reader.figures(utf8(batch.columns[-1])))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(score)], names=[*batch.schema.names[:-1], "score"])

    return run


def score(docs: DataFrame, model: Classifier) -> DataFrame:
    """``doc_id`` and ``score`` of every document."""
    narrow = docs.select("doc_id", docs["text"].cast("string").alias("_text"))
    return narrow.mapInArrow(_scored(model), f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, score double")


def query(spark, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Toxicity score of every document by a classifier trained on posterior labels."""
    return score(docs, fit(docs, labels)).select(
        "doc_id", (id_remainder("doc_id", DIVISOR) == HELD).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def _clean(model: Classifier, column: int):
    def run(batches):
        import pyarrow as pa

        reader = Reader(model.lexicon)
        for batch in batches:
            yield batch.filter(pa.array(model.score(reader.figures(utf8(batch.column(column)))) < THRESHOLD))

    return run


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier does not reject."""
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.mapInArrow(_clean(model, docs.columns.index("text")), docs.schema)
