"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math
import os
import unicodedata

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.session import materialize

#: What separates words and makes up blank lines: space and code points 9 to 13.
BLANKS = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(df: DataFrame, column: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def id_remainder(column: str, divisor: int) -> Column:
    """crc32 of the id written as text, modulo ``divisor`` (null id: of the empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(divisor))


def with_place(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a column that tells its rows apart, and that column's name.

    A row's place is its file and its number in the file. It is the same in every
    job, also when executors were lost in between and files are split differently.
    ``docs`` is a scan of Parquet files, filtered or not; a frame without such places
    is stored first.
    """
    name = "_place"
    while name.lower() in map(str.lower, docs.columns):
        name += "_"
    try:
        return _placed(docs, name), name
    except AnalysisException:
        return _placed(materialize(docs, "documents"), name), name


def _placed(docs: DataFrame, name: str) -> DataFrame:
    at = docs.metadataColumn("_metadata")
    return docs.withColumn(name, F.struct(F.xxhash64(at["file_path"]).alias("file"), at["row_index"].alias("row")))


def numbered(df: DataFrame, by: list[str], bucket: str, order: list[Column], name: str) -> DataFrame:
    """Add the position (from 0) of each row among the rows with equal ``by`` values.

    Rows are ordered by the ``bucket`` column first and by ``order`` inside it.
    Buckets are counted, their counts summed up, and only the rows of one bucket
    are sorted together, so a ``by`` value with a third of all rows is spread
    over as many tasks as it has buckets.
    """
    keys = [*by, bucket]
    before = Window.partitionBy(*by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sizes = df.groupBy(*keys).agg(F.count("*").alias("_size"))
    starts = sizes.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"),
    )
    inside = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("_inside", F.row_number().over(inside) - 1)
    match = F.lit(True)
    for i, k in enumerate(keys):
        match = match & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return ranked.join(starts, match).select(
        *df.columns, (F.col("_start") + F.col("_inside")).cast("long").alias(name))


def bucket_count(rows: int, least: int = 256, size: int = 1 << 18) -> int:
    """Buckets for :func:`numbered` by hash: their number grows with the rows."""
    return max(least, math.ceil(rows / size))


class ChunkEncoder:
    """Token ids of whole texts, through a bounded memo of blank-separated chunks.

    The pre-tokenizer of ``word_bpe_49k.json`` never joins characters across
    white space, so a text's ids are those of its chunks one after the other.
    Chunks recur, so most are looked up; new ones go to the tokenizer together.
    Case does not matter to this tokenizer, so ASCII letters are lowered first;
    a text that holds the marker of a special token is encoded as it stands.
    """

    def __init__(self, path: str | None = None, memo: int = 600_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("word_bpe_49k.json")
        self.tokenizer, self.limit, self.memo = Tokenizer.from_file(path), memo, {}
        self.model, self.bytes_of = self.tokenizer.model, {}
        self.byte_level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.marks = dict(zip(".,", self._ids([".", ","])))

    def _ids(self, texts: list[str]) -> list[bytes]:
        import numpy as np

        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, "<u4").tobytes() for e in found]

    def _word(self, word: str) -> bytes:
        """Ids of one normalised run of letters, which the pre-tokenizer keeps in one piece."""
        import struct

        for c in word:
            if c not in self.bytes_of:
                self.bytes_of[c] = "".join(piece for piece, _ in self.byte_level.pre_tokenize_str(c))
        ids = [t.id for t in self.model.tokenize("".join(map(self.bytes_of.__getitem__, word)))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _learn(self, chunks: set[bytes]) -> None:
        memo, other = self.memo, {}
        for chunk in chunks:
            text = chunk.decode("utf-8", "replace")
            # A full stop or comma after letters is a token of its own.
            mark = text[-1] if text[-1] in ".," else ""
            word = unicodedata.normalize("NFC", text[:-1] if mark else text).lower()
            if not word.isalpha() or "\u03a3" in text:  # a capital sigma's lower case depends on its place
                other[chunk] = text
                continue
            stem = chunk[:-1] if mark else chunk
            if stem not in memo:
                memo[stem] = self._word(word)
            if mark:
                memo[chunk] = memo[stem] + self.marks[mark]
        for chunk, ids in zip(other, self._ids(list(other.values()))):
            memo[chunk] = ids

    def encode(self, texts: list[bytes]):
        """For each UTF-8 text its ids, as little-endian 32-bit bytes."""
        for at in range(0, len(texts), 256):
            block = texts[at : at + 256]
            plain = [None if b"<|" in t else t.lower().split() for t in block]
            if len(self.memo) > self.limit:
                self.memo.clear()
            memo = self.memo
            if new := {c for chunks in plain if chunks for c in chunks if c not in memo}:
                self._learn(new)
            for text, chunks in zip(block, plain):
                if chunks is None:
                    yield self._ids([text.decode("utf-8", "replace")])[0]
                else:
                    yield b"".join(map(memo.__getitem__, chunks))


def shared_encoder(path: str | None = None) -> ChunkEncoder:
    """The worker process's one encoder for this vocabulary, kept from task to task.

    Functions travel by value, so a global of this module would be made anew with
    each task; the library that the encoder wraps is the same throughout a process.
    """
    import tokenizers

    kept = vars(tokenizers).setdefault("_encoders_by_path", {})
    if path not in kept:
        kept[path] = ChunkEncoder(path)
    return kept[path]


def utf8(column) -> list[bytes]:
    """An Arrow string column as UTF-8 bytes, null as empty."""
    import pyarrow as pa

    return [v or b"" for v in column.cast(pa.binary()).to_pylist()]
