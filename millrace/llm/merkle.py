"""Merkle dataset manifest: postorder logs of 16-ary trees, closed-form positions, proofs.

Every row is a leaf, the hash of its fields. The leaves of a source, in order of their
id, are the first level of a tree; every 16 nodes of a level (the last run may hold
fewer) become one node of the next, until one is left, the source's subroot. The subroots,
in order of their sources, are the leaves of one more tree, whose top is the root.

Leaves are sorted by range and numbered. Blocks of 16^3 consecutive leaves go to one builder
each. A builder writes nodes as they are completed, so its part of the log is in
postorder; the place of a node in its tree's whole log follows from its level, its
number and the tree's number of leaves alone (:func:`position`), so builders need not
know of one another. The nodes that builders end with are built over by the next pass.
Proofs are read from the log from the top down, block by block: a block is handed the
siblings above it, finds its own by their positions, and hands both on.

No task holds more than one block of nodes and the path above it, whatever the size of a
source; texts are hashed where they are read, only ids and digests are shuffled.

Defined cases: a null field is hashed as ``-``; a null source is a source of its own, the
first; a null id comes first in its source, and counts as the empty text where its crc32 is
asked for; rows of one id are ordered by their leaves, and repeated rows are leaves
each; a source of one row has its leaf as subroot; an empty table has no root and an
empty result. Only the five fields are read, so other columns may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import id_remainder, with_place
from millrace.session import materialize

FAN, SPAN = 16, 3
BLOCK = FAN**SPAN
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOG = "tree string, n long, level int, index long, position long, hash string"
BELOW = "tree string, n long, index long, subroot string, left array<string>, right array<string>"


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*fields: Column) -> Column:
    """Hex sha256 of the fields, each as its length and value."""
    return F.sha2(F.concat(*map(_field, fields)).cast("binary"), 256)


def height(n: int) -> int:
    """Levels above the leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def _height(n: Column) -> Column:
    return sum(((n > FAN**k).cast("int") for k in range(15)), F.lit(0))


def position(level: int, index: int, n: int) -> int:
    """Place (from 0) of a node in the postorder log of a tree of ``n`` leaves.

    When the node is written, of its own level and those below all nodes up to its last
    leaf are there; of a level above, those whose last leaf lies before the node.
    """
    before, width = -1, 1
    for below in range(level, -1, -1):
        size = -(-n // FAN**below)
        before += min(size, (index + 1) * width)
        width *= FAN
    while index:
        index //= FAN
        before += index
    return before


def _indexed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with the ``index`` of each in its ``tree`` and the tree's size ``n``.

    Sorted into ranges first, so a tree with a third of all rows lies in many parts.
    """
    parts = materialize(rows.repartitionByRange("tree", *order).withColumn("_part", F.spark_partition_id()), "ranges")
    tree = Window.partitionBy("tree")
    starts = parts.groupBy("tree", "_part").agg(F.count("*").alias("_size")).select(
        "tree", "_part", F.sum("_size").over(tree).alias("n"),
        (F.sum("_size").over(tree.orderBy("_part")) - F.col("_size")).alias("_start"))
    inside = Window.partitionBy("tree", "_part").orderBy(*order)
    return parts.withColumn("_inside", F.row_number().over(inside) - 1).join(starts, ["tree", "_part"]).select(
        *rows.columns, "n", (F.col("_start") + F.col("_inside")).alias("index"))


def _builder(low: int):
    """Writes the nodes over one block of level ``low`` in the order of their completion."""

    def build(key, block):
        import hashlib

        import pyarrow as pa

        block = block.sort_by("index")
        tree, n, first = block.column("tree")[0].as_py(), block.column("n")[0].as_py(), block.column("index")[0].as_py()
        hashes, top = block.column("hash").to_pylist(), height(n)
        out, open_runs = [], [[] for _ in range(SPAN + 1)]
        last = -(-n // FAN**low) - 1  # the level's last node closes all runs
        for index, own in enumerate(hashes, first):
            level, at = low, index
            while True:
                if level > low or low == 0:
                    out.append((level, at, position(level, at, n), own))
                if level == top or level == low + SPAN:
                    break
                run = open_runs[level - low]
                run.append(own)
                if (at + 1) % FAN and index != last:
                    break
                own = hashlib.sha256("".join(run).encode()).hexdigest()
                run.clear()
                level, at = level + 1, at // FAN
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.string()]
        columns = [pa.array(c, t) for c, t in zip(zip(*out), kinds)] if out else [pa.array([], t) for t in kinds]
        return pa.table([pa.array([tree] * len(out), pa.string()), pa.array([n] * len(out), pa.int64()), *columns],
                        names=["tree", "n", "level", "index", "position", "hash"])

    return build


def _build(leaves: DataFrame, most: int) -> DataFrame:
    """The log of all trees over numbered leaves (``tree``, ``n``, ``index``, ``hash``)."""
    nodes, low, logs = leaves.select("tree", "n", "index", "hash"), 0, []
    while True:
        blocks = nodes.groupBy("tree", F.floor(F.col("index") / BLOCK).alias("block"))
        logs.append(materialize(blocks.applyInArrow(_builder(low), LOG), "log"))
        low += SPAN
        if most <= FAN**low:
            break
        nodes = logs[-1].filter((F.col("level") == low) & (F.col("n") > FAN**low)).select("tree", "n", "index", "hash")
    out = logs[0]
    for part in logs[1:]:
        out = out.unionByName(part)
    return out


def _siblings(low: int, hashes: dict, n: int, block: int):
    """``steps(index)`` of one block: the joined hashes left and right of a node of level ``low`` and of all above it in the block."""
    top, runs = min(height(n), low + SPAN), {}

    def steps(index):
        out = []
        for level in range(low, top):
            run = index // FAN
            if (level, run) not in runs:
                members = range(run * FAN, min((run + 1) * FAN, -(-n // FAN**level)))
                runs[level, run] = [hashes[position(level, i, n)] for i in members]
            own, at = runs[level, run], index % FAN
            out.append(("".join(own[:at]), "".join(own[at + 1 :])))
            index = run
        return out

    return steps


def _opened(block):
    """A block's hashes by position, its path from above (left, right), and its tree's subroot."""
    hashes, above = {}, None
    for at, own, left, right in zip(*(block.column(c).to_pylist() for c in ("position", "hash", "left", "right"))):
        if at is None:
            above = (left, right, own)
        else:
            hashes[at] = own
    return hashes, above


def _descend(low: int):
    """The paths of the nodes of level ``low``, from those of the blocks."""

    def run(key, block):
        import pyarrow as pa

        hashes, above = _opened(block)
        tree, number, n = key[0].as_py(), key[1].as_py(), block.column("n")[0].as_py()
        steps, out = _siblings(low, hashes, n, number), []
        for level, index in zip(block.column("level").to_pylist(), block.column("index").to_pylist()):
            if level == low:
                own = steps(index)
                out.append((index, [*(s[0] for s in own), *above[0]], [*(s[1] for s in own), *above[1]]))
        lists = pa.list_(pa.string())
        return pa.table([
            pa.array([tree] * len(out), pa.string()), pa.array([n] * len(out), pa.int64()), pa.array([o[0] for o in out], pa.int64()),
            pa.array([above[2]] * len(out), pa.string()), pa.array([o[1] for o in out], lists), pa.array([o[2] for o in out], lists),
        ], names=["tree", "n", "index", "subroot", "left", "right"])

    return run


def _blocks(log: DataFrame, low: int, paths: DataFrame) -> DataFrame:
    """The log's nodes of one pass with their blocks, and a row with the path above each block."""
    inside = F.floor(F.col("index") / F.pow(F.lit(float(FAN)), F.lit(low + SPAN) - F.col("level"))).cast("long")
    # A tree whose top lies on this level already is opened by a lower pass.
    opened = F.col("level").between(low, low + SPAN - 1) & ((F.col("n") > FAN**low) | F.lit(low == 0))
    nodes = log.filter(opened).select(
        "tree", inside.alias("block"), "n", "level", "index", "position", "hash",
        F.lit(None).cast("array<string>").alias("left"), F.lit(None).cast("array<string>").alias("right"))
    above = paths.select(
        "tree", F.col("index").alias("block"), "n", F.lit(-1).alias("level"), F.lit(None).cast("long").alias("index"),
        F.lit(None).cast("long").alias("position"), F.col("subroot").alias("hash"), "left", "right")
    return nodes.unionByName(above)


def _start(trees: DataFrame, low: int) -> DataFrame:
    """The trees whose uppermost runs belong to the pass of level ``low``, as paths of their only block."""
    pass_of = F.floor((F.greatest(_height(F.col("n")), F.lit(1)) - 1) / SPAN) * SPAN
    return trees.filter(pass_of == low).select("tree", "n", F.lit(0).cast("long").alias("index"), "subroot", "left", "right")


def _paths(log: DataFrame, trees: DataFrame, most: int) -> DataFrame:
    """Blocks of the lowest pass, each with its nodes and the path above it; ``trees`` has the paths above the trees."""
    low = max(height(most) - 1, 0) // SPAN * SPAN
    paths = _start(trees, low)
    while low:
        blocks = _blocks(log, low, paths).groupBy("tree", "block")
        below = materialize(blocks.applyInArrow(_descend(low), BELOW), "paths")
        low -= SPAN
        paths = below.unionByName(_start(trees, low))
    return _blocks(log, 0, paths)


@dataclass
class Manifest:
    """Stored leaves, the sources' logs, the numbered sources with the log over their subroots, and the root.

    ``most`` is the number of leaves of the largest source, ``count`` the number of sources.
    """

    leaves: DataFrame
    log: DataFrame
    sources: DataFrame
    top: DataFrame
    root: str | None
    most: int
    count: int

    def blocks(self) -> DataFrame:
        """Per block of leaves: its part of the log, and the siblings above it up to the root."""
        empty = F.array().cast("array<string>")
        whole = _tops(self.top).select("tree", "n", F.col("hash").alias("subroot"), empty.alias("left"), empty.alias("right"))
        found = _paths(self.top, whole, self.count).groupBy("tree", "block").applyInArrow(_descend(0), BELOW)
        above = self.sources.select(F.col("name").alias("tree"), "index").join(found.select("index", "left", "right"), "index").drop("index")
        trees = _tops(self.log).select("tree", "n", F.col("hash").alias("subroot"))
        return _paths(self.log, trees.join(above, "tree"), self.most)


def _tops(log: DataFrame) -> DataFrame:
    return log.filter((F.col("index") == 0) & (F.col("level") == _height(F.col("n"))))


def manifest(docs: DataFrame, carry: dict[str, Column] | None = None) -> Manifest:
    """Build the manifest of ``docs``; its leaves keep ``doc_id`` and the columns of ``carry``."""
    carry = carry or {}
    placed, place = with_place(docs)
    source = F.col("source").cast("string")
    rows = placed.select(
        F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("tree"), "doc_id", leaf(*map(F.col, FIELDS)).alias("hash"),
        *[c.alias(n) for n, c in carry.items()], F.xxhash64(place).alias("_tie"))
    # Stored before they are sorted: sorting reads its rows twice, and these are texts no more.
    rows = materialize(rows, "digests")
    leaves = materialize(_indexed(rows, ["doc_id", "hash", "_tie"]).drop("_tie"), "leaves")
    most = leaves.agg(F.max("n")).first()[0]
    if most is None:
        return Manifest(leaves, leaves, leaves, leaves, None, 0, 0)
    log = _build(leaves, most)
    subroots = _tops(log).select(F.lit("").alias("tree"), F.col("tree").alias("name"), "hash")
    sources = materialize(_indexed(subroots, ["name"]), "sources")
    count = sources.count()
    top = _build(sources, count)
    return Manifest(leaves, log, sources, top, _tops(top).first()["hash"], most, count)


def _judged(root: str, columns: list[str]):
    """Per block of leaves: proofs, and the roots that fold from the leaves as they are now."""

    def run(key, leaves, block):
        import hashlib

        import pyarrow as pa

        sha = lambda *parts: hashlib.sha256("".join(parts).encode()).hexdigest()
        out = []
        if leaves.num_rows:
            hashes, (left, right, subroot) = _opened(block)
            n = leaves.column("n")[0].as_py()
            steps = _siblings(0, hashes, n, key[1].as_py())
            above = list(zip(left, right))
            upper = "".join(a + b for a, b in above)
            for index, own, now in zip(*(leaves.column(c).to_pylist() for c in ("index", "hash", "now"))):
                inside, folded = steps(index), now or own
                for a, b in inside:
                    folded = sha(a, folded, b)
                for a, b in above:
                    folded = sha(a, folded, b)
                out.append((subroot, sha(*(a + b for a, b in inside), upper), folded))
        made = [pa.array(c, pa.string()) for c in zip(*out)] if out else [pa.array([], pa.string())] * 3
        return pa.table([leaves.column("doc_id"), leaves.column("hash"), made[0], pa.array([root] * len(out), pa.string()), *made[1:],
                         pa.array([o[2] == root for o in out], pa.bool_())], names=columns)

    return run


OUTPUT = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def verify(docs: DataFrame, tampered: Column, now: Column) -> DataFrame:
    """Every row's leaf, proof digest, and the root folded from its leaf; where ``tampered`` holds, from the leaf with text ``now``."""
    changed = F.when(tampered, leaf(*map(F.col, FIELDS[:-1]), now))
    made = manifest(docs, {"now": changed})
    kinds = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {', '.join(f'{c} string' for c in OUTPUT[1:-1])}, verified boolean"
    if made.root is None:
        return docs.sparkSession.createDataFrame([], kinds)
    leaves = made.leaves.withColumn("block", F.floor(F.col("index") / BLOCK))
    keys = ["tree", "block"]
    return leaves.groupBy(*keys).cogroup(made.blocks().groupBy(*keys)).applyInArrow(_judged(made.root, OUTPUT), kinds)


def query(spark, docs: DataFrame) -> DataFrame:
    """Manifest over all documents; a fifth of the texts is lower-cased afterwards and found by its proofs."""
    return verify(docs, id_remainder("doc_id", 5) == 0, F.translate("text", UPPER, LOWER))


def _levels(name: str, leaves: str, by: str, depth: int) -> str:
    """CTEs of one kind of tree: levels, and for each leaf the siblings of all its levels."""
    run = f"PARTITION BY {by}, i // {FAN} ORDER BY i ROWS BETWEEN"
    out = [f"{name}0 AS (SELECT {by}, i, h, count(*) OVER (PARTITION BY {by}) AS c FROM {leaves})"]
    for k in range(depth):
        out.append(f"""{name}s{k} AS (SELECT {by}, i, CASE WHEN c = 1 THEN '' ELSE coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') END AS a,
  CASE WHEN c = 1 THEN '' ELSE coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') END AS b, c > 1 AS more FROM {name}{k})""")
        out.append(f"""{name}{k + 1} AS (SELECT *, count(*) OVER (PARTITION BY {by}) AS c FROM (
  SELECT {by}, i // {FAN} AS i, CASE WHEN any_value(c) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h FROM {name}{k} GROUP BY {by}, i // {FAN}))""")
    return ",\n".join(out)


def check_sql(depth: int = 5, top: int = 3) -> str:
    """The same in DuckDB, for at most 16^``depth`` rows a source and 16^``top`` sources."""
    field = lambda c: f"coalesce(CAST(octet_length(encode(CAST({c} AS VARCHAR))) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"
    first = " || ".join(map(field, FIELDS[:-1]))
    fold = lambda h, s: f"CASE WHEN {s}.more THEN sha256({s}.a || {h} || {s}.b) ELSE {h} END"
    joins, chain, proof = "", [], []
    for k in range(depth):
        joins += f"\nJOIN ss{k} ON ss{k}.src = l.src AND ss{k}.i = l.i // {FAN**k}"
        proof.append(f"ss{k}.a || ss{k}.b")
        chain.append(f"ss{k}")
    joins += "\nJOIN tops t ON t.src = l.src"
    for k in range(top):
        joins += f"\nJOIN ts{k} ON ts{k}.i = t.i // {FAN**k}"
        proof.append(f"ts{k}.a || ts{k}.b")
        chain.append(f"ts{k}")
    folds, at = [], "proven"
    for k, s in enumerate(chain):
        folds.append(f"f{k} AS (SELECT * REPLACE (CASE WHEN more[{k + 1}] THEN sha256(a[{k + 1}] || now || b[{k + 1}]) ELSE now END AS now) FROM {at})")
        at = f"f{k}"
    listed = lambda c: "[" + ", ".join(f"{s}.{c}" for s in chain) + "]"
    rounds = "list_reduce([xor(x, y), 0, 0, 0, 0, 0, 0, 0, 0], lambda p, q: xor(p >> 1, (p & 1) * 3988292384))"
    return f"""
WITH leaves AS (
  SELECT *, row_number() OVER (PARTITION BY src ORDER BY doc_id NULLS FIRST, h) - 1 AS i FROM (
    SELECT doc_id, coalesce('=' || source, '') AS src, sha256({first} || {field('text')}) AS h,
      CASE WHEN xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(d) + 1), lambda n: CAST(ascii(d[n]) AS BIGINT))), lambda x, y: {rounds}), 4294967295) % 5 = 0
        THEN sha256({first} || {field(f"translate(text, '{UPPER}', '{LOWER}')")}) END AS now
    FROM (SELECT *, coalesce(CAST(doc_id AS VARCHAR), '') AS d FROM documents))
), {_levels('s', 'leaves', 'src', depth)},
tops AS (SELECT src, h, row_number() OVER (ORDER BY encode(src)) - 1 AS i, 0 AS one FROM s{depth}),
{_levels('t', 'tops', 'one', top)},
proven AS (
  SELECT l.doc_id, l.h AS leaf, t.h AS subroot, (SELECT h FROM t{top}) AS root, sha256({' || '.join(proof)}) AS proof_sha256,
    coalesce(l.now, l.h) AS now, {listed('a')} AS a, {listed('b')} AS b, {listed('more')} AS more
  FROM leaves l{joins}
), {', '.join(folds)}
SELECT doc_id, leaf, subroot, root, proof_sha256, now AS folded_root, now = root AS verified FROM {at}"""
