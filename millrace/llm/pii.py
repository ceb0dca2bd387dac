"""Personal data: base patterns plus a skip-chain conditional random field.

Base patterns find e-mail addresses, IP addresses, card and phone numbers. They miss
other spellings of what they found: a card number with dots, a phone number without
its country code, an e-mail user on its own. So every document becomes a graph: its
mentions (base matches and look-alikes) are nodes with labels, neighbouring mentions
share a chain potential, and all mentions of the same digits or the same user share
skip potentials, however far apart. Base matches are clamped; loopy sum-product
messages spread their labels, and a look-alike whose most likely label is a kind of
personal data becomes a span.

The potentials are trained piece by piece: label counts per shape of mention, per pair
of neighbours and per pair of similar mentions, over all documents, with base labels.
Mentions with one key are tied through a hub node, so a key with n mentions costs n
edges. Counts number at most a few hundred cells, whatever the corpus.

Defined cases: a null text counts as empty and has no spans; very long texts are read
whole, in time linear in their length; repeated rows are judged each; an empty table
gives an empty result; only id and text are read, and the stage keeps whatever columns
there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
#: Neighbours in the chain are mentions at most so many characters apart.
NEAR = 40


def _patterns():
    import re

    return {
        "domain": re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
        "local": re.compile(r"[A-Za-z0-9._%+-]+\Z"),
        # Digits before the first dot can't start a match if the whole run can't.
        "ip": re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        "card": re.compile(r"[0-9](?:[\x20-]?[0-9])+"),
        "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
        "digit": re.compile(r"[0-9]"),
        "number": re.compile(r"(?<![0-9A-Za-z])\(?[0-9][0-9().\x20/-]{5,}[0-9](?![0-9A-Za-z])"),
        "word": re.compile(r"[^\x20\x09-\x0D]+"),
    }


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def base_spans(text: str, p: dict) -> list[tuple[int, int, int]]:
    """(start, index of the kind, end) of all base matches, in order."""
    out = []
    if "@" in text:
        done, at = 0, text.find("@")
        while at >= 0:
            # The longest run of local-part characters that ends at this sign.
            start = at
            while start > done and text[start - 1] in LOCAL:
                start -= 1
            found = p["domain"].match(text, at + 1) if start < at else None
            if found:
                out.append((start, 0, found.end()))
                done = found.end()
            at = text.find("@", max(at + 1, done))
    if not p["digit"].search(text):
        return sorted(out)
    for m in p["ip"].finditer(text):
        parts = [x.lstrip("0") for x in m[0].split(".")]
        if all(len(x) < 3 or len(x) == 3 and x <= "255" for x in parts):
            out.append((m.start(), 1, m.end()))
    for m in p["card"].finditer(text):
        digits = _digits(m[0])
        if 12 <= len(digits) <= 19 and _luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in p["phone"].finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def mentions(text: str, base: list[tuple[int, int, int]], p: dict) -> list[tuple[int, int, int, str, list[str]]]:
    """(start, end, label or -1 if open, shape, keys) of base matches and look-alikes, in order."""
    out, users = [], set()
    for start, kind, end in base:
        found = text[start:end]
        if kind == 0:
            user = found.split("@")[0].casefold()
            users.add(user)
            out.append((start, end, 1, "email", [f"u{user}"]))
        else:
            digits = _digits(found)
            out.append((start, end, kind + 1, _shape(found, digits), _keys(digits)))
    free, at = [], 0
    for start, _, end in base:
        if start > at:
            free.append((at, start))
        at = max(at, end)
    free.append((at, len(text)))
    if p["digit"].search(text):
        for a, b in free:
            for m in p["number"].finditer(text, a, b):
                digits = _digits(m[0])
                if len(digits) >= 7:
                    out.append((m.start(), m.end(), -1, _shape(m[0], digits), _keys(digits)))
    # A user's name alone counts if it can't be an ordinary word.
    users = {u for u in users if len(u) >= 5 and any(c in "0123456789._%+-" for c in u)}
    if users:
        for a, b in free:
            for m in p["word"].finditer(text, a, b):
                word = m[0].strip(".,;:!?()<>[]\"'")
                if word.casefold() in users:
                    start = m.start() + m[0].index(word)
                    out.append((start, start + len(word), -1, "user", [f"u{word.casefold()}"]))
    return sorted(out)


def _shape(text: str, digits: str) -> str:
    marks = "".join(sorted({c for c in text if not "0" <= c <= "9"}))
    check = "L" if 12 <= len(digits) <= 19 and _luhn(digits) else ""
    return f"{min(len(digits), 20)}{marks}{check}"


def _keys(digits: str) -> list[str]:
    """All digits, and the last nine, which a number keeps without its country code."""
    return [f"d{digits}", *([f"e{digits[-9:]}"] if len(digits) >= 9 else [])]


def _counts():
    """Label counts of one task: per shape, per pair of neighbours, per pair of a key and its mentions."""

    def run(batches):
        from collections import Counter

        import pyarrow as pa

        p, seen = _patterns(), Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if not text or "@" not in text and not p["digit"].search(text):
                    continue
                found = mentions(text, base_spans(text, p), p)
                groups = {}
                for i, (start, _, label, shape, keys) in enumerate(found):
                    seen["shape", shape, max(label, 0)] += 1
                    if i and start - found[i - 1][1] <= NEAR:
                        seen["chain", str(max(found[i - 1][2], 0)), max(label, 0)] += 1
                    # Look-alikes are what is to be inferred: only base matches teach agreement.
                    for key in keys if label >= 0 else ():
                        if key in groups:
                            seen["skip", str(groups[key]), label] += 1
                        groups[key] = label
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in seen], "string"), pa.array([k[1] for k in seen], "string"),
             pa.array([k[2] for k in seen], "i4"), pa.array(list(seen.values()), "i8")], names=["part", "cell", "label", "n"])

    return run


class Potentials:
    """Log potentials from counts: labels given the shape, and how much likelier label pairs are than chance."""

    def __init__(self, rows):
        import numpy as np

        k = len(LABELS)
        shapes, pairs = {}, {"chain": np.zeros((k, k)), "skip": np.zeros((k, k))}
        every = np.zeros(k)
        for part, cell, label, n in rows:
            if part == "shape":
                shapes.setdefault(cell, np.zeros(k))[label] += n
                every[label] += n
            else:
                pairs[part][int(cell), label] += n
        prior = (every + 1) / (every.sum() + k)
        self.unknown = np.log(prior)
        # Base patterns call every look-alike "none", so a shape alone never settles the label.
        self.shapes = {s: np.maximum(np.log((n + prior) / (n.sum() + 1)), -4.0) for s, n in shapes.items()}
        chance = prior[:, None] * prior[None, :]

        def lift(counts, strength):
            both = counts + counts.T
            return np.log((both + strength * chance) / (both.sum() + strength) / chance)

        self.chain = np.clip(lift(pairs["chain"], 50.0), -2, 2)
        # Similar mentions that base patterns read alike agree; a floor keeps messages finite.
        agree = lift(pairs["skip"], 1.0)
        own = np.eye(k) * np.maximum(np.diag(agree), 1.0)
        self.skip = np.where(np.eye(k) > 0, own, np.clip(agree, -6, -3))

    def node(self, shape: str):
        return self.shapes.get(shape, self.unknown)


def infer(nodes, edges, potentials, rounds: int = 20, damping: float = 0.3):
    """Marginals by loopy sum-product messages; ``edges`` are (a, b, matrix index) arrays."""
    import numpy as np

    def logsum(x, axis):
        top = x.max(axis, keepdims=True)
        return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))

    a, b, kind = edges
    # Both directions of every edge; the matrices are symmetric.
    source, target, tie = np.r_[a, b], np.r_[b, a], potentials[np.r_[kind, kind]]
    other = np.r_[np.arange(len(a)) + len(a), np.arange(len(a))]
    messages = np.zeros((len(source), nodes.shape[1]))
    for _ in range(rounds if len(a) else 0):
        belief = nodes.copy()
        np.add.at(belief, target, messages)
        new = logsum((belief[source] - messages[other])[:, :, None] + tie, 1)
        new -= logsum(new, 1)[:, None]
        new = damping * messages + (1 - damping) * new
        change = np.abs(new - messages).max()
        messages = new
        if change < 1e-3:
            break
    belief = nodes.copy()
    np.add.at(belief, target, messages)
    return np.exp(belief - logsum(belief, 1)[:, None])


def _find(potentials: Potentials):
    """A function from texts to their (base spans, added spans), for whole batches at once."""
    import numpy as np

    p, k = _patterns(), len(LABELS)
    ties = np.stack([potentials.chain, potentials.skip])

    def spans(texts):
        base, open_nodes = [], []
        nodes, edges = [], []
        for row, text in enumerate(texts):
            base.append([])
            if not text or "@" not in text and not p["digit"].search(text):
                continue
            base[-1] = base_spans(text, p)
            found = mentions(text, base[-1], p)
            if all(m[2] >= 0 for m in found):
                continue
            first, hubs = len(nodes), {}
            for i, (start, end, label, shape, _) in enumerate(found):
                if label < 0:
                    open_nodes.append((row, start, end, len(nodes)))
                    nodes.append(potentials.node(shape))
                else:
                    nodes.append(np.where(np.arange(k) == label, 0.0, -50.0))
                if i and start - found[i - 1][1] <= NEAR:
                    edges.append((first + i - 1, first + i, 0))
            for i, m in enumerate(found):
                for key in m[4]:
                    hubs.setdefault(key, []).append(first + i)
            for members in hubs.values():
                if len(members) > 1:
                    edges += [(m, len(nodes), 1) for m in members]
                    nodes.append(np.zeros(k))
        added = [[] for _ in texts]
        if open_nodes:
            table = np.array(edges, "i8").reshape(-1, 3).T
            marginal = infer(np.array(nodes), table, ties)
            for row, start, end, node in open_nodes:
                label = int(marginal[node].argmax())
                if label and marginal[node, label] >= 0.5:
                    added[row].append((start, label - 1, end))
        return base, added

    return spans


def fit(df: DataFrame, text: str = "text") -> Potentials:
    """Potentials from the base labels of all documents."""
    narrow = df.select(df[text].cast("string").alias("text"))
    counts = narrow.mapInArrow(_counts(), "part string, cell string, label int, n long")
    total = counts.groupBy("part", "cell", "label").agg(F.sum("n").alias("n")).orderBy("part", "cell", "label")
    return Potentials([tuple(r) for r in total.collect()])


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _digest(potentials: Potentials):
    def run(batches):
        from hashlib import sha256

        import pyarrow as pa

        find = _find(potentials)
        for batch in batches:
            base, added = find(batch.columns[-1].to_pylist())
            counts = [pa.array([sum(s[1] == k for s in spans) for spans in base], "i8") for k in range(len(KINDS))]
            marks = pa.array([sha256(_joined(s).encode()).hexdigest() for s in base])
            every = pa.array([_joined(sorted(b + a)) for b, a in zip(base, added)])
            more = pa.array([len(a) for a in added], "i8")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts, marks, every, more],
                names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added"])

    return run


def detect(df: DataFrame, potentials: Potentials, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts, base digest and all spans of every document."""
    narrow = df.select(df[id].alias("doc_id"), df[text].cast("string").alias("_text"))
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    shape = f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, {counts}, base_sha256 string, spans string, n_added long"
    return narrow.mapInArrow(_digest(potentials), shape)


def query(spark, docs: DataFrame) -> DataFrame:
    """Personal data in every document: base matches and what label consistency adds."""
    return detect(docs, fit(docs))


def redact(text: str, spans) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    out, at, i = [], 0, 0
    spans = sorted(spans)
    while i < len(spans):
        start, kind, end = spans[i]
        i += 1
        while i < len(spans) and spans[i][0] < end:
            end = max(end, spans[i][2])
            i += 1
        out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def _redacted(potentials: Potentials, columns: list[str]):
    def run(batches):
        import pyarrow as pa

        find = _find(potentials)
        for batch in batches:
            texts = batch.column(columns.index("text")).to_pylist()
            new = [redact(t, b + a) if b or a else t for t, (b, a) in zip(texts, zip(*find(texts)))]
            out = list(batch.columns)
            out[columns.index("text")] = pa.array(new, batch.schema.field("text").type)
            if "n_chars" in columns:
                # Rows whose text is unchanged keep the length they came with.
                at = columns.index("n_chars")
                sizes = [len(n) if n is not None and n != t else c for n, t, c in zip(new, texts, out[at].to_pylist())]
                out[at] = pa.array(sizes, batch.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays(out, schema=batch.schema)

    return run


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data replaced by its kind."""
    return docs.mapInArrow(_redacted(fit(docs), docs.columns), docs.schema)
