"""Near-duplicate groups by SimHash and multi-index hashing.

Every text gets a 64-bit fingerprint over its word shingles. Fingerprints are cut
into segments; two that differ in at most ``distance`` bits agree in one segment up
to distance // segments bits. So each distinct fingerprint is put into one table per
segment, looks up the small Hamming ball round its own segment value, and every
match is verified over all 64 bits. A pair at segment distance d is looked up from
one side only: by the fingerprint that has a 0 in the highest differing bit.

Copies are folded into one fingerprint first. Inside a table entry only a spanning
forest of the links is returned, since only the groups are wanted; an entry with more
than ``block`` fingerprints or look-ups is cut into pairs of blocks that go to different
tasks, so no task holds more than two blocks of one entry.
All links are found, none is capped or sampled.

Defined cases: null and blank texts have fingerprint zero and are linked like any
other; a text of fewer words than a shingle has its whole word sequence as its only
shingle; repeated rows keep one output row each; null ids stay null and never become a
group's id unless all its ids are null; an empty table gives an empty result; only the
id and text columns are read, other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from millrace.llm.components import components
from millrace.llm.common import utf8, with_place
from millrace.session import materialize

#: Hashes whose bits are added up at a time.
ROWS_AT_ONCE = 1 << 18


def _bit_majorities(hashes, sizes):
    """For each text, from its run of shingle hashes, the bits set in over half of them."""
    import numpy as np

    # Entry b holds the eight bits of byte b, one in each byte lane.
    spread = np.unpackbits(np.arange(256, dtype="u1")[:, None], axis=1, bitorder="little").view("<u8")[:, 0]
    ends = np.cumsum(sizes)
    votes = np.zeros((len(sizes), 64), "i8")
    owner = np.repeat(np.arange(len(sizes)), sizes)
    for at in range(0, len(hashes), ROWS_AT_ONCE):
        lanes = spread[hashes[at : at + ROWS_AT_ONCE].view("u1").reshape(-1, 8)]
        own = owner[at : at + ROWS_AT_ONCE]
        # A lane counts to 255, so runs are cut at texts and every 255 hashes.
        new = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        starts = np.unique(np.concatenate([new, *[np.arange(a, b, 255) for a, b in zip(new, np.r_[new[1:], len(own)]) if b - a > 255]]))
        sums = np.add.reduceat(lanes, starts, axis=0).view("u1").reshape(len(starts), 64)
        np.add.at(votes, own[starts], sums)
    bits = votes * 2 > np.asarray(sizes)[:, None]
    return np.packbits(bits, axis=1, bitorder="little").view("<u8")[:, 0] if len(ends) else np.zeros(0, "<u8")


def _fingerprints(words: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from xxhash import xxh64_intdigest

        for batch in batches:
            sizes, hashes = [], []
            for text in utf8(batch.columns[-1]):
                # bytes.lower() lowers A-Z only; bytes.split() cuts at space and 9 to 13.
                parts = text.lower().split()
                if len(parts) <= words:
                    found = [xxh64_intdigest(b" ".join(parts), 42)] if parts else []
                else:
                    line = b" ".join(parts)
                    ends = np.cumsum([len(p) + 1 for p in parts])
                    starts = [0, *ends[: len(parts) - words].tolist()]
                    found = [xxh64_intdigest(line[a:b], 42) for a, b in zip(starts, (ends[words - 1 :] - 1).tolist())]
                sizes.append(len(found))
                hashes.append(np.array(found, "<u8"))
            joined = np.concatenate(hashes) if hashes else np.zeros(0, "<u8")
            marks = _bit_majorities(joined, np.array(sizes, "i8"))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(marks.view("<i8"))], names=[*batch.schema.names[:-1], "fp"])

    return run


def fingerprints(df: DataFrame, keep: list[str], text: str = "text", words: int = 4) -> DataFrame:
    """The columns ``keep`` and the 64-bit fingerprint ``fp`` (as a signed long) of every row."""
    narrow = df.select(*[df[k] for k in keep], df[text].cast("string").alias("_text"))
    out = StructType([*narrow.schema.fields[:-1], StructField("fp", LongType())])
    return narrow.mapInArrow(_fingerprints(words), out)


def _segments(parts: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each segment."""
    edges = [round(i * 64 / parts) for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _masks(width: int, radius: int) -> list[int]:
    from itertools import combinations

    return [sum(1 << b for b in bits) for r in range(1, radius + 1) for bits in combinations(range(width), r)]


def _entries(parts: int, radius: int):
    """Table rows (``probe`` false) and look-ups (true): ``seg``, ``val``, ``fp``, ``probe``."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            every = batch.column(0).to_numpy(zero_copy_only=False).view("<u8")
            for at in range(0, len(every), 4096):
                fps = every[at : at + 4096]
                for seg, (low, width) in enumerate(_segments(parts)):
                    own = (fps >> np.uint64(low)) & np.uint64((1 << width) - 1)
                    vals, who, probe = [own], [fps], [np.zeros(len(fps), bool)]
                    for mask in _masks(width, radius):
                        high = np.uint64(1 << (mask.bit_length() - 1))
                        asks = (own & high) == 0
                        vals.append(own[asks] ^ np.uint64(mask))
                        who.append(fps[asks])
                        probe.append(np.ones(len(vals[-1]), bool))
                    val = np.concatenate(vals)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(val), seg, "i4")), pa.array(val.view("<i8")),
                        pa.array(np.concatenate(who).view("<i8")), pa.array(np.concatenate(probe))],
                        names=["seg", "val", "fp", "probe"])

    return run


def _forest(table, probes, distance: int):
    """Links of a spanning forest over one table entry: peel off whatever the last found nodes reach.

    A node leaves the open set once reached, so a dense entry costs little more
    than its size; look-ups are compared with the table, not with each other.
    """
    import numpy as np

    links, open_table, open_probes = [], table, probes
    while len(open_table):
        stack, open_table = [(open_table[0], True)], open_table[1:]
        while stack:
            node, stored = stack.pop()
            near = np.bitwise_count(open_table ^ node) <= distance
            found = [(x, True) for x in open_table[near]]
            open_table = open_table[~near]
            if stored and len(open_probes):
                near = np.bitwise_count(open_probes ^ node) <= distance
                found += [(x, False) for x in open_probes[near]]
                open_probes = open_probes[~near]
            links += [(node, x) for x, _ in found]
            stack += found
    return links


def _links(distance: int, small: int = 24):
    """Links between fingerprints that meet in a table entry; rows come sorted by entry, table rows first."""

    def entry_links(keys, fps, probe):
        import numpy as np

        new = np.r_[True, keys[1:] != keys[:-1]] if len(keys) else np.zeros(0, bool)
        starts = np.flatnonzero(new)
        sizes = np.diff(np.r_[starts, len(keys)])
        run = np.cumsum(new) - 1
        out = []
        # Entries of a few rows, all at once: every row against the k-th after it.
        few = sizes[run] <= small if len(run) else new
        for k in range(1, small):
            a = np.arange(len(keys) - k)
            a = a[few[a] & (run[a] == run[a + k]) & ~probe[a]]
            if not len(a):
                break
            a = a[np.bitwise_count(fps[a] ^ fps[a + k]) <= distance]
            out.append(np.stack([fps[a], fps[a + k]], 1))
        for i in np.flatnonzero(sizes > small):
            part = slice(starts[i], starts[i] + sizes[i])
            table = ~probe[part]
            links = _forest(fps[part][table], fps[part][~table], distance)
            out.append(np.array(links, "<u8").reshape(-1, 2))
        return np.concatenate(out) if out else np.zeros((0, 2), "<u8")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        held = None
        for batch in batches:
            now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            if held is not None:
                now = [np.concatenate([a, b]) for a, b in zip(held, now)]
            keys = now[0]
            # The last entry may go on in the next batch.
            cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            held = [x[cut:] for x in now]
            links = entry_links(keys[:cut], now[1][:cut].view("<u8"), now[2][:cut]).view("<i8")
            if len(links):
                yield pa.RecordBatch.from_arrays([pa.array(links[:, 0].copy()), pa.array(links[:, 1].copy())], names=["u", "v"])
        if held is not None:
            links = entry_links(held[0], held[1].view("<u8"), held[2]).view("<i8")
            if len(links):
                yield pa.RecordBatch.from_arrays([pa.array(links[:, 0].copy()), pa.array(links[:, 1].copy())], names=["u", "v"])

    return run


def _cells(entries: DataFrame) -> DataFrame:
    """Entries cut into ``_kt`` blocks of table rows and ``_kp`` of look-ups: a row for every cell that a row belongs to.

    A cell is a pair of blocks, of two table blocks or of a table block and one of
    look-ups, so all pairs meet in some cell and no cell holds more than two blocks.
    Entries without numbers of blocks are one cell.
    """
    kt, kp = F.col("_kt"), F.col("_kp")
    cell = lambda number, probe: F.struct(number.alias("_cell"), probe.alias("probe"))
    own = F.pmod(F.xxhash64("fp"), F.when(F.col("probe"), kp).otherwise(kt))
    upto = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    # In a pair of table blocks the later block's rows take the place of look-ups.
    among = F.transform(upto(kt), lambda i: cell(F.least(i, own) * kt + F.greatest(i, own), i < own))
    asked = F.transform(upto(kp), lambda q: cell(kt * kt + own * kp + q, F.lit(False)))
    asking = F.transform(upto(kt), lambda i: cell(kt * kt + i * kp + own, F.lit(True)))
    where = F.when(kt.isNull(), F.array(cell(F.lit(0).cast("long"), F.col("probe")))).when(
        F.col("probe"), asking).otherwise(F.concat(among, asked))
    return entries.select("seg", "val", "fp", F.explode(where).alias("_in")).select("seg", "val", "fp", "_in._cell", "_in.probe")


def linked(
    distinct: DataFrame, distance: int = 4, segments: int | None = None, block: int = 1 << 16,
    radius: int | None = None, entries_of=_entries, links_of=_links,
) -> DataFrame:
    """Links ``u``, ``v`` that connect the distinct fingerprints ``fp`` exactly as all pairs within ``distance`` do.

    That holds for the radius distance // segments; a smaller ``radius`` finds those of
    the pairs that differ in at most so many bits in one segment.

    ``segments`` only trades look-ups for table sizes: three suit up to some ten
    million fingerprints, two suit more.
    """
    if segments is None:
        segments = 3 if distinct.count() < 1 << 26 else 2
    kind = distinct.schema["fp"].dataType.simpleString()
    shape = f"seg int, val long, fp {kind}, probe boolean"
    radius = distance // segments if radius is None else radius
    entries = distinct.select("fp").mapInArrow(entries_of(segments, radius), shape).withColumn("_cell", F.lit(0).cast("long"))
    masks = [(seg, mask) for seg, (_, width) in enumerate(_segments(segments)) for mask in _masks(width, radius)]
    # An entry none of whose neighbours is crowded gets at most ``block`` look-ups.
    crowded = block // max(1, len(masks) // segments)
    stored = distinct.select("fp").mapInArrow(entries_of(segments, 0), shape).groupBy("seg", "val").agg(F.count("*").alias("n"))
    large = materialize(stored.filter(F.col("n") > crowded), "large")
    if large.limit(1).count():
        balls = distinct.sparkSession.createDataFrame([*masks, (-1, 0)], "seg int, mask long")
        around = large.join(F.broadcast(balls), "seg").select(
            "seg", F.col("val").bitwiseXOR(F.col("mask")).alias("val"), F.lit(0).alias("t"), F.col("n").alias("p"))
        parts = lambda n: F.greatest(F.ceil(F.sum(n) / block), F.lit(1)).cast("long")
        hot = large.select("seg", "val", F.col("n").alias("t"), F.lit(0).alias("p")).unionByName(around).groupBy("seg", "val").agg(
            parts("t").alias("_kt"), parts("p").alias("_kp")).filter("_kt > 1 or _kp > 1")
        entries = _cells(entries.drop("_cell").join(hot, ["seg", "val"], "left"))
    # One number for an entry and cell; equal numbers of different entries cost a comparison, never a link.
    entry = F.xxhash64("seg", "val", "_cell")
    ordered = entries.select(entry.alias("entry"), "fp", "probe").repartition("entry").sortWithinPartitions("entry", "probe")
    return ordered.mapInArrow(links_of(distance), f"u {kind}, v {kind}")


def groups(marks: DataFrame, distance: int = 4) -> DataFrame:
    """``fp`` and ``root``, equal for fingerprints that links connect, of every distinct fingerprint of ``marks``."""
    distinct = materialize(marks.select("fp").distinct(), "distinct")
    roots = components(linked(distinct, distance))
    return distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(
    df: DataFrame, id: str = "doc_id", text: str = "text", words: int = 4, distance: int = 4,
) -> DataFrame:
    """``id``, ``fp`` and ``component`` (the smallest id reachable over links) of every row."""
    marks = materialize(fingerprints(df.select(df[id].alias("id"), df[text].alias("text")), ["id"], "text", words), "fingerprints")
    least = marks.groupBy("fp").agg(F.min("id").alias("least"))
    grouped = materialize(least.join(groups(marks, distance), "fp"), "groups")
    ids = grouped.groupBy("root").agg(F.min("least").alias("component"))
    named = grouped.join(ids, "root").select(F.col("fp").alias("_fp"), "component")
    return marks.join(named, marks["fp"] == named["_fp"]).select("id", "fp", "component")


def query(spark, docs: DataFrame) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    return near_duplicates(docs).select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"))


def keep_one(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with one row of each group of near copies: that of the smallest id.

    Near copies share 0.8 or more of their runs of five words, see ``near_copies``; the
    query's settings are not the stage's.
    Of repeated rows with that id the one that stands first in the files stays (files
    in order of a hash of their path); groups without any id keep their first row.
    """
    from millrace.llm.near_copies import near_copies

    placed, place = with_place(docs)
    order = [F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col(place).alias("place")]
    kept = materialize(near_copies(placed, place, "place", order).select(F.col("first.place").alias(place)), "kept")
    # Kept rows grow with the input: the same shuffled join at every size.
    return placed.join(kept.hint("merge"), place, "left_semi").select(*[placed[c] for c in docs.columns])
