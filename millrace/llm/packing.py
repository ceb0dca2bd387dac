"""Best-fit packing of token pieces into sequences, in bulk-synchronous supersteps.

Documents are tokenised once, cut where longer than the capacity, and stored as
pieces (numbers only, or with their ids). Lengths run from 1 to the capacity, so the
range-sorted documents and gaps are kept run-length encoded: how many pieces have a
length, and which runs of sequences have a gap. One superstep takes the longest
length left and sweeps over its successors, the gaps of that size or more from the
smallest up; the pieces of this length are matched to them all at once, conflicts
being resolved by rank: the k-th piece takes the k-th place. Gaps are updated and the
next superstep follows. This equals best-fit decreasing piece by piece.

The sweep's state is bounded by the capacity (counts per length, a few runs per
length), whatever the corpus. The pieces themselves never leave Spark: their ranks
within a length come from distributed counts, so a length shared by a third of all
pieces is spread over many tasks, and each task looks up its pieces' places.

Defined cases: a null or empty text is the end token alone; repeated rows are packed
each; ties among equal lengths go by hash, id and piece; an empty table gives no
pieces; only the id and text columns are read, other columns may have any name.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from millrace.llm.common import bucket_count, numbered, shared_encoder, utf8
from millrace.session import materialize

CAPACITY = 4096
END = 1


def _cut(capacity: int, tokenizer: str | None, keep_ids: bool):
    def run(batches):
        import zlib

        import numpy as np
        import pyarrow as pa

        encoder, end = shared_encoder(tokenizer), np.array([END], "<u4").tobytes()
        for batch in batches:
            rows, piece, start, length, crc, kept = [], [], [], [], [], []
            for row, ids in enumerate(encoder.encode(utf8(batch.columns[-1]))):
                ids += end
                for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append(row)
                    piece.append(n)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if keep_ids:
                        kept.append(np.frombuffer(part, "<i4"))
            out = [batch.column(0).take(pa.array(rows, "i8")), pa.array(piece, "i4"),
                   pa.array(start, "i8"), pa.array(length, "i8"), pa.array(crc, "i8")]
            names = ["id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                out, names = [*out, pa.array(kept, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(out, names=names)

    return run


def pieces(
    df: DataFrame, id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
    tokenizer: str | None = None, keep_ids: bool = False,
) -> DataFrame:
    """The token pieces of every text: ``id``, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if wanted, ``ids``."""
    narrow = df.select(df[id].alias("id"), df[text].cast("string").alias("text"))
    shape = [narrow.schema["id"], StructField("piece", IntegerType()), *[
        StructField(n, LongType()) for n in ("start", "length", "ids_crc32")]]
    if keep_ids:
        shape.append(StructField("ids", ArrayType(IntegerType())))
    return narrow.mapInArrow(_cut(capacity, tokenizer, keep_ids), StructType(shape))


def sweep(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over run-length encoded lengths.

    Returns runs (length, first rank, first sequence, places per sequence, offset of
    the first place): the pieces of that length from that rank on fill sequence after
    sequence, each with so many of them side by side.
    """
    runs: dict[int, list[tuple[int, int]]] = {}  # gap -> runs of sequences (first, number)
    sizes: list[int] = []  # the gaps in order
    out, sequences = [], 0

    def leave(gap: int, first: int, number: int) -> None:
        if gap and number:
            if gap not in runs:
                insort(sizes, gap)
                runs[gap] = []
            runs[gap].append((first, number))

    for length in sorted(counts, reverse=True):
        left, rank, fitted = counts[length], 0, []
        while left:
            at = bisect_left(sizes, length)
            if at < len(sizes):
                gap = sizes[at]
                first, number = runs[gap].pop()
                if not runs[gap]:
                    del runs[gap], sizes[at]
            else:
                gap, first, number = capacity, sequences, -(-left // (capacity // length))
                sequences += number
            each = gap // length
            full = min(number, left // each)
            if full:
                out.append((length, rank, first, each, capacity - gap))
                fitted.append((gap - each * length, first, full))
                rank, left = rank + full * each, left - full * each
            if full < number and left:
                # The last sequence of this superstep takes fewer pieces than would fit.
                out.append((length, rank, first + full, left, capacity - gap))
                fitted.append((gap - left * length, first + full, 1))
                rank, left, full = rank + left, 0, full + 1
            if full < number:
                fitted.append((gap, first + full, number - full))
        for gap in fitted:
            leave(*gap)
    return out


def _placed(runs: list[tuple[int, int, int, int, int]], capacity: int, whole: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        table = np.array(sorted(runs), "i8").reshape(-1, 5)
        # One number orders runs by length, then first rank; ranks stay below 2^48.
        keys = (table[:, 0] << 48) + table[:, 1]
        for batch in batches:
            at = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in ("length", "rank")}
            full = at["length"] == capacity
            if len(table):
                own = np.maximum(np.searchsorted(keys, (at["length"] << 48) + at["rank"], "right") - 1, 0)
                _, first_rank, first, each, offset = table[own].T
                place = at["rank"] - first_rank
                sequence = first + place // each + whole
                offset = offset + place % each * at["length"]
            else:
                sequence = offset = np.zeros(batch.num_rows, "i8")
            sequence, offset = np.where(full, at["rank"], sequence), np.where(full, 0, offset)
            kept = batch.select([n for n in batch.schema.names if n != "rank"])
            yield kept.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    return run


def pack(
    df: DataFrame, id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
    tokenizer: str | None = None, keep_ids: bool = False,
) -> DataFrame:
    """The pieces of every text with ``sequence_id`` and ``offset`` of their place; with ``keep_ids`` their token ids."""
    stored = materialize(pieces(df, id, text, capacity, tokenizer, keep_ids), "pieces")
    counts = {r["length"]: r["n"] for r in stored.groupBy("length").agg(F.count("*").alias("n")).collect()}
    whole = counts.get(capacity, 0)
    runs = sweep({length: n for length, n in counts.items() if length < capacity}, capacity)
    buckets = bucket_count(sum(counts.values()))
    dealt = stored.withColumn("_bucket", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(buckets)))
    order = [F.col(c) for c in ("id", "piece", "start", "ids_crc32")]
    ranked = numbered(dealt, ["length"], "_bucket", order, "rank").drop("_bucket")
    shape = StructType([*stored.schema, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    return ranked.mapInArrow(_placed(runs, capacity, whole), shape)


def query(spark, docs: DataFrame) -> DataFrame:
    """Every document's pieces and their places in sequences of 4096 tokens."""
    return pack(docs).select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed sequences of the documents, one row per piece."""
    return query(spark, docs)
