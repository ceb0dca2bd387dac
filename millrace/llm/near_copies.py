"""Near-copy groups by exact similarity: wide SimHash candidates, verified word by word.

A text's shingles are its distinct runs of five words; two texts are near copies if the
Jaccard similarity of their shingles is 0.8 or more. Texts of equal shingles are folded
into one set first. Every set has a SimHash of two halves of 64 bits. Sets meet by
multi-index hashing over the first half and are candidates if they differ in at most
``DISTANCE`` of all 128 bits: pairs at 0.8 differ in 19 bits on average, unrelated ones in
64. Candidates that are connected form a crowd; inside a crowd all pairs are compared by
their shingles, and only pairs that are similar enough link.

The first segment's candidates are connected before the others are looked at. Sets then
carry the group they are in, and an entry of another segment only says which groups it
joins, so a crowd hands over few links however many entries its sets meet in.

A crowd of more than ``block`` sets is cut into blocks. First each block meets itself and
the crowd's least set; then whatever is not yet linked to that set meets all blocks. So a
crowd of near copies costs what it holds, and no task holds more than two blocks.

Missed are only pairs beyond the candidate distance that no other candidates connect.

Defined cases: null and blank texts have no shingles and are copies of one another; a
text of fewer words than a shingle has its whole word sequence as its only shingle;
repeated rows are copies of one another, told apart by their place; an empty table has
no groups; only the text, the place and the columns of ``order`` are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import utf8
from millrace.llm.components import components
from millrace.llm.simhash import _bit_majorities, _masks, _segments, linked
from millrace.session import materialize

WORDS, SIMILAR = 5, 0.8
DISTANCE, SEGMENTS, RADIUS = 32, 7, 1
PAIR = "struct<a:bigint,b:bigint>"


def shingles(text: bytes):
    """Sorted distinct 64-bit hashes of the runs of five words; words and case as in the fingerprints."""
    import numpy as np
    from xxhash import xxh64_intdigest

    parts = text.lower().split()
    line = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts], dtype="i8")
    if len(parts) <= WORDS:
        return np.array([xxh64_intdigest(line, 42)] if parts else [], "<u8")
    starts = [0, *ends[: len(parts) - WORDS].tolist()]
    return np.unique(np.array([xxh64_intdigest(line[a:b], 42) for a, b in zip(starts, (ends[WORDS - 1 :] - 1).tolist())], "<u8"))


def _signed(arrays):
    import pyarrow as pa

    return pa.StructArray.from_arrays([pa.array(x.view("<i8")) for x in arrays], names=["a", "b", "root"][: len(arrays)])


def _halves(column):
    return [x.to_numpy(zero_copy_only=False).view("<u8") for x in column.flatten()]


def _marks():
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from xxhash import xxh64_intdigest

        for batch in batches:
            found, halves = [], ([], [])
            for at in range(0, batch.num_rows, 256):
                own = [shingles(t) for t in utf8(batch.columns[-1].slice(at, 256))]
                found += [(xxh64_intdigest(s.tobytes()), len(s)) for s in own]
                first, sizes = np.concatenate(own), np.array([len(s) for s in own], "i8")
                second = (first ^ (first >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
                second = (second ^ (second >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
                for half, hashes in zip(halves, (first, second ^ (second >> np.uint64(31)))):
                    half.append(_bit_majorities(hashes, sizes))
            fp = [np.concatenate(h) if h else np.zeros(0, "<u8") for h in halves]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(np.array([f[0] for f in found], "<u8").view("<i8")), _signed(fp), pa.array([f[1] for f in found], "i8")],
                names=[*batch.schema.names[:-1], "same", "fp", "n"])

    return run


def _entries(parts: int, radius: int, chosen: list[int]):
    """As in ``simhash``, by the ``chosen`` segments of the first half of the fingerprint."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            every = _halves(batch.column(0))
            for at in range(0, batch.num_rows, 4096):
                fps = [h[at : at + 4096] for h in every]
                for seg in chosen:
                    low, width = _segments(parts)[seg]
                    own = (fps[0] >> np.uint64(low)) & np.uint64((1 << width) - 1)
                    rows = np.arange(len(own))
                    vals, who = [own], [rows]
                    for mask in _masks(width, radius):
                        asks = rows[(own & np.uint64(1 << (mask.bit_length() - 1))) == 0]
                        vals.append(own[asks] ^ np.uint64(mask))
                        who.append(asks)
                    val, who = np.concatenate(vals), np.concatenate(who)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(val), seg, "i4")), pa.array(val.view("<i8")), _signed([f[who] for f in fps]),
                         pa.array(np.arange(len(val)) >= len(own))], names=["seg", "val", "fp", "probe"])

    return run


def _links(distance: int):
    """Links of spanning forests of the entries over the rows' groups; rows come sorted by entry, table rows first."""

    def apart(links, root):
        """Those links that join two groups not yet joined by earlier ones."""
        import numpy as np

        links = links[root[links[:, 0]] != root[links[:, 1]]]
        up, kept = {}, []

        def top(x):
            while (y := up.get(x, x)) != x:
                up[x] = x = up.get(y, y)
            return x

        for k, (a, b) in enumerate(zip(root[links[:, 0]].tolist(), root[links[:, 1]].tolist())):
            a, b = top(a), top(b)
            if a != b:
                up[a] = b
                kept.append(k)
        return links[np.array(kept, "i8")]

    def forest(first, second, probe):
        """Peel off whatever the last found rows reach; look-ups reach table rows only."""
        import numpy as np

        links, left = [], np.arange(len(first))
        for start in np.flatnonzero(~probe):
            if not len(left) or left[0] != start:
                continue
            stack, left = [start], left[1:]
            while stack and len(left):
                node = stack.pop()
                near = np.bitwise_count(first[left] ^ first[node]) + np.bitwise_count(second[left] ^ second[node]) <= distance
                if not near.any():
                    continue
                near &= ~(probe[left] & probe[node])
                links += [(node, x) for x in left[near].tolist()]
                stack += left[near].tolist()
                left = left[~near]
        return np.array(links, "i8").reshape(-1, 2)

    def found(keys, first, second, root, probe):
        import numpy as np

        edges = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True]) if len(keys) else np.zeros(1, "i8")
        pairs = [apart(forest(first[a:b], second[a:b], probe[a:b]), root[a:b]) + a for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()) if b - a > 1 and not probe[a]]
        return np.concatenate(pairs) if pairs else np.zeros((0, 2), "i8")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def batch_of(now):
            pairs = found(*now)
            return pa.RecordBatch.from_arrays([_signed([h[pairs[:, i]] for h in now[1:4]]) for i in (0, 1)], names=["u", "v"])

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [batch.column(0).to_numpy(), *_halves(batch.column(1)), batch.column(2).to_numpy(zero_copy_only=False)]
            if held is not None:
                now = [np.concatenate([a, b]) for a, b in zip(held, now)]
            cut = int(np.searchsorted(now[0], now[0][-1]))
            held = [x[cut:] for x in now]
            yield batch_of([x[:cut] for x in now])
        if held is not None:
            yield batch_of(held)

    return run


def similar_links(sets: list, names: list[int]) -> list[tuple[int, int]]:
    """Links that connect the sets (sorted hashes) exactly as all pairs of Jaccard similarity 0.8 or more do."""
    import numpy as np

    sizes = np.array([len(s) for s in sets], "i8")
    order = np.argsort(sizes, kind="stable")
    # All shingles as small numbers, so one look-up table tells which are a set's.
    numbers = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)[1].astype("i4")
    starts, own = np.r_[0, np.cumsum(sizes[order])], sizes[order]
    mark, links, left = np.zeros(len(numbers) + 1, bool), [], np.ones(len(sets), bool)
    for start in range(len(sets)):
        stack = [start] if left[start] else []
        left[start] = False
        while stack:
            node = stack.pop()
            # Similar sets are of similar size, so they stand close in the order.
            low = np.searchsorted(own, SIMILAR * own[node] - 1e-9, "left")
            high = np.searchsorted(own, own[node] / SIMILAR + 1e-9, "right")
            near = low + np.flatnonzero(left[low:high])
            if not len(near):
                continue
            mine = numbers[starts[node] : starts[node + 1]]
            mark[mine] = True
            if len(near) * 4 < high - low:
                shared = np.array([np.count_nonzero(mark[numbers[starts[i] : starts[i + 1]]]) for i in near.tolist()], "i8")
            else:
                sums = np.r_[0, np.cumsum(mark[numbers[starts[low] : starts[high]]])]
                shared = sums[starts[near + 1] - starts[low]] - sums[starts[near] - starts[low]]
            mark[mine] = False
            hit = near[shared >= SIMILAR * (own[node] + own[near] - shared) - 1e-9]
            left[hit] = False
            links += [(names[order[node]], names[order[i]]) for i in hit.tolist()]
            stack += hit.tolist()
    return links


def _compared(table):
    import pyarrow as pa

    names, rows = table.column("same").to_pylist(), table.column("grams").combine_chunks()
    links = similar_links([rows[i].values.to_numpy() for i in range(len(rows))], names) if len(names) > 1 else []
    return pa.table({"u": pa.array([x[0] for x in links], "i8"), "v": pa.array([x[1] for x in links], "i8")})


def _grams():
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                own = [shingles(t).view("<i8") for t in utf8(part.columns[-1])]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(own, pa.list_(pa.int64()))], names=[*part.schema.names[:-1], "grams"])

    return run


def _roots(nodes: DataFrame, key, links: DataFrame) -> DataFrame:
    """``nodes`` with the ``root`` that links connect them to."""
    roots = components(links).withColumnRenamed("node", "_node")
    return nodes.withColumn("_key", key).join(roots, F.col("_key") == F.col("_node"), "left").select(
        *nodes.columns, F.coalesce("root", "_key").alias("root"))


def near_copies(df: DataFrame, place: str, at: str, order: list, text: str = "text", block: int = 512, block_shingles: int = 1 << 19) -> DataFrame:
    """For every group of near copies the ``first`` row's struct of ``order``, whose field ``at`` is the column ``place`` that tells rows apart."""
    narrow = df.select(F.struct(*order).alias("order"), df[text].cast("string").alias("_text"))
    marks = narrow.mapInArrow(_marks(), f"order {narrow.schema['order'].dataType.simpleString()}, same long, fp {PAIR}, n long")
    sets = materialize(marks.groupBy("same").agg(F.min("order").alias("first"), F.min("fp").alias("fp"), F.max("n").alias("n")), "sets")

    def met(fps: DataFrame, chosen: list[int]) -> DataFrame:
        links = linked(fps, DISTANCE, SEGMENTS, radius=RADIUS, entries_of=lambda parts, radius: _entries(parts, radius, chosen), links_of=_links)
        return links.select(F.col("u.root").alias("u"), F.col("v.root").alias("v"))

    grouped = lambda root: F.struct("fp.a", "fp.b", root.alias("root")).alias("fp")
    own = materialize(sets.select("fp").distinct().select(grouped(F.xxhash64("fp"))), "alone")
    first = components(met(own, [0]))
    named = own.join(first, F.col("fp.root") == F.col("node"), "left").select(grouped(F.coalesce("root", F.col("fp.root"))))
    more = met(materialize(named, "grouped"), [*range(1, SEGMENTS)])
    crowds = materialize(_roots(sets, F.xxhash64("fp"), first.toDF("u", "v").unionByName(more)), "crowds")
    parts = F.greatest(F.ceil(F.count("*") / block), F.ceil(F.sum("n") / block_shingles)).cast("long")
    large = crowds.groupBy("root").agg(F.count("*").alias("c"), parts.alias("k"), F.min("same").alias("least")).filter("c > 1").drop("c")
    members = crowds.join(large, "root").select("same", F.col(f"first.{at}").alias("_at"), F.col("root").alias("crowd"), "k", "least")
    held = df.select(df[place].alias("_place"), df[text].cast("string").alias("_text")).join(
        members.hint("merge"), F.col("_place") == F.col("_at")).select("same", "crowd", "k", "least", "_text")
    grams = materialize(held.mapInArrow(_grams(), "same long, crowd long, k long, least long, grams array<bigint>"), "grams")

    def compared(rows: DataFrame) -> DataFrame:
        return materialize(rows.select("crowd", "cell", "same", "grams").groupBy("crowd", "cell").applyInArrow(_compared, "u long, v long"), "similar")

    own = F.pmod(F.xxhash64("same"), F.col("k"))
    every = F.sequence(F.lit(0).cast("long"), F.col("k") - 1)
    # The least set meets all blocks of its crowd, every other set its own.
    cells = F.when(F.col("same") == F.col("least"), every).otherwise(F.array(own))
    links = compared(grams.withColumn("cell", F.explode(cells)))
    cut = grams.filter("k > 1")
    if cut.limit(1).count():
        # Sets not yet linked to the least one, in blocks of their own, meet all blocks.
        linked_now = _roots(cut.select("same", "crowd", "least"), F.col("same"), links)
        centre = linked_now.filter("same = least").select(F.col("crowd").alias("_crowd"), F.col("root").alias("_centre"))
        rest = materialize(linked_now.join(centre, F.col("crowd") == F.col("_crowd")).filter("root <> _centre").select("same", "crowd"), "rest")
        blocks = rest.groupBy("crowd").agg(F.ceil(F.count("*") / block).cast("long").alias("r"))
        meets = cut.join(blocks, "crowd").join(rest.select("same", F.lit(True).alias("alone")), "same", "left")
        side = F.pmod(F.xxhash64(F.lit(1), "same"), F.col("r"))
        asked = F.transform(F.sequence(F.lit(0).cast("long"), F.col("r") - 1), lambda i: i * F.col("k") + own)
        asking = F.transform(every, lambda i: side * F.col("k") + i)
        both = F.when(F.col("alone"), F.array_union(asked, asking)).otherwise(asked)
        links = links.unionByName(compared(meets.withColumn("cell", F.explode(both))))
    return _roots(sets.select("same", "first"), F.col("same"), links).groupBy("root").agg(F.min("first").alias("first")).select("first")
