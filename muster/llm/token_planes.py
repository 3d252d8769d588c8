"""Token ids on disk: blocks of ids transposed into byte planes, each compressed, with an index of documents."""

from __future__ import annotations

import functools
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer, pre_tokenizers

from muster.llm.common import SLICE, Stage, slices

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END = 1
#: Ids of a block; the last block of a shard is shorter.
BLOCK = 1 << 16
LEVEL = 1
#: Words whose ids a task remembers before it forgets all of them.
_REMEMBERED = 200_000

#: One row per block. ``planes``: byte 0 of all ids, then byte 1, ..., each a zstandard frame. The other columns are the
#: block's index: where it begins in its shard, and each document piece in it (the document's place in the shard, its id, the
#: piece's number and length, and whether the document ends here).
BLOCKS = (
    "shard int, block int, first long, n_ids int, planes array<binary>, "
    "pieces array<struct<place:long,doc_id:long,piece:int,length:int,last:boolean>>"
)


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


#: A word of ASCII and Latin-1 letters, with or without ASCII marks behind it: the tokenizer cuts it just there. Lower-cased,
#: such letters are what its model takes, byte by byte in its own spelling, and none of them is composed any further.
_ASCII_MARKS = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum())
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)")


class _Words(dict):
    """Ids of words as little-endian 32-bit numbers, asked of the tokenizer once."""

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = _tokenizer(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.parts: dict[bytes | str, bytes] = {}
        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelled = {code: spell(chr(code))[0][0] for code in range(0xC0, 0x100)}

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= _REMEMBERED:
            self.clear()
            if len(self.parts) >= _REMEMBERED:
                self.parts.clear()
        letters = word.rstrip(_ASCII_MARKS)
        if letters.isalpha():  # ASCII letters only: of other letters no byte is one
            lower = letters.lower()
            ids = self.parts.get(lower)
            if ids is None:
                ids = self.parts[lower] = array("I", [token.id for token in self.tokenize(lower.decode())]).tobytes()
            if len(letters) < len(word):
                ids += self._whole(word[len(letters) :].decode())
        else:
            ids = self._other(word.decode())
        self[word] = ids
        return ids

    def _other(self, text: str) -> bytes:
        plain = _PLAIN.fullmatch(text)
        if not plain:
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        # The model's ids of lower-case letters in its own spelling, which the tokenizer would leave as one part.
        letters, marks = plain[1].lower(), plain[2]
        ids = self.parts.get(letters)
        if ids is None:
            ids = array("I", [token.id for token in self.tokenize(letters.translate(self.spelled))]).tobytes()
            self.parts[letters] = ids
        return ids + self._whole(marks) if marks else ids

    def _whole(self, marks: str) -> bytes:
        ids = self.parts.get(marks)
        if ids is None:
            ids = self.parts[marks] = array("I", self.tokenizer.encode(marks, add_special_tokens=False).ids).tobytes()
        return ids


@functools.lru_cache(maxsize=2)
def _words(path: str) -> _Words:
    return _Words(path)


def encode(texts: list[str | None], path: str = TOKENIZER) -> list[bytes]:
    """Ids of whole texts, each with the end id.

    The tokenizer drops white space and never merges across it, so a text's ids are those of its parts between ASCII white
    space, each asked for once. White space of other scripts stays inside its part.
    """
    find = _words(path).__getitem__
    end = array("I", [END]).tobytes()
    return [b"".join(map(find, (text or "").encode().split())) + end for text in texts]


def to_planes(ids: np.ndarray) -> list[bytes]:
    """A block's ids as one zstandard frame per byte place."""
    compressor = zstandard.ZstdCompressor(level=LEVEL)
    planes = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return [compressor.compress(plane.tobytes()) for plane in planes]


def from_planes(planes: list[bytes], n_ids: int) -> np.ndarray:
    """The inverse of ``to_planes``."""
    reader = zstandard.ZstdDecompressor()
    raw = [np.frombuffer(reader.decompress(plane, max_output_size=n_ids), np.uint8) for plane in planes]
    return np.ascontiguousarray(np.stack(raw).T).view("<u4").reshape(-1)


class _Shard:
    """Blocks of one task's documents, in order."""

    def __init__(self, number: int):
        self.number, self.block, self.first, self.place = number, 0, 0, 0
        self.parts: list[bytes] = []
        self.filled = 0
        self.pieces: list[dict] = []

    def add(self, doc_id: int | None, ids: bytes) -> Iterator[dict]:
        at, piece, total = 0, 0, len(ids) // 4
        while at < total:
            n = min(total - at, BLOCK - self.filled)
            self.parts.append(ids[4 * at : 4 * (at + n)])
            last = at + n == total
            self.pieces.append({"place": self.place, "doc_id": doc_id, "piece": piece, "length": n, "last": last})
            self.filled += n
            at, piece = at + n, piece + 1
            if self.filled == BLOCK:
                yield self.flush()
        self.place += 1

    def flush(self) -> dict:
        ids = np.frombuffer(b"".join(self.parts), "<u4")
        row = {"shard": self.number, "block": self.block, "first": self.first, "n_ids": len(ids)}
        row |= {"planes": to_planes(ids), "pieces": self.pieces}
        self.block, self.first = self.block + 1, self.first + len(ids)
        self.parts, self.filled, self.pieces = [], 0, []
        return row


def write(docs: DataFrame, path: str, tokenizer: str = TOKENIZER) -> None:
    """Encode ``docs`` (doc_id, text) in ascending doc_id, nulls first, and write the blocks to ``path``.

    Each range of ids is a shard, written by one task; shards are numbered in the order of their ids.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        schema = pa.schema(_ARROW)
        shard = _Shard(TaskContext.get().partitionId())
        for batch in slices(batches, SLICE // 2):
            encoded = encode(batch.column(1).to_pylist(), tokenizer)
            rows = [row for d, ids in zip(batch.column(0).to_pylist(), encoded, strict=True) for row in shard.add(d, ids)]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)
        if shard.filled:
            yield pa.RecordBatch.from_pylist([shard.flush()], schema)

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    ordered = source.repartitionByRange(parts, F.col("doc_id"), F.xxhash64("text")).sortWithinPartitions(
        "doc_id", F.xxhash64("text")
    )
    ordered.select("doc_id", "text").mapInArrow(run, BLOCKS).write.option("compression", "none").parquet(path)


_PIECE = pa.struct(
    [("place", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("length", pa.int32()), ("last", pa.bool_())]
)
_ARROW = [
    ("shard", pa.int32()),
    ("block", pa.int32()),
    ("first", pa.int64()),
    ("n_ids", pa.int32()),
    ("planes", pa.list_(pa.binary())),
    ("pieces", pa.list_(_PIECE)),
]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Block by block: its pieces (place, doc_id, piece, length, last), their shard and start within it, and its ids."""
    for batch in batches:
        for at in range(batch.num_rows):
            block = batch.slice(at, 1)
            shard, first, n_ids = (block.column(name)[0].as_py() for name in ("shard", "first", "n_ids"))
            ids = from_planes(block.column("planes")[0].as_py(), n_ids)
            pieces = pa.RecordBatch.from_struct_array(block.column("pieces").flatten())
            ends = np.cumsum(pieces.column("length").to_numpy(), dtype=np.int64)
            yield pieces, np.full(len(ends), shard, np.int32), first + ends - pieces.column("length").to_numpy(), ids


def read(spark: SparkSession, path: str) -> DataFrame:
    """(shard, place, doc_id, piece, last, start, ids) of the document pieces in the blocks; ``start`` within the shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pieces, shards, starts, ids in _pieces(batches):
            ends = 4 * np.cumsum(pieces.column("length").to_numpy(), dtype=np.int64)
            offsets = pa.py_buffer(np.concatenate(([0], ends)).astype(np.int32))
            raw = pa.Array.from_buffers(pa.binary(), len(ends), [None, offsets, pa.py_buffer(ids.tobytes())])
            columns = [pa.array(shards), *(pieces.column(c) for c in ("place", "doc_id", "piece", "last")), pa.array(starts), raw]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "place", "doc_id", "piece", "last", "start", "ids"])

    schema = "shard int, place long, doc_id long, piece int, last boolean, start long, ids binary"
    return spark.read.schema(BLOCKS).parquet(path).mapInArrow(run, schema)


def digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone.

    ``start`` counts the ids of all documents before it, ``ids_crc32`` is over its ids as little-endian 32-bit numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pieces, shards, starts, ids in _pieces(batches):
            raw, sizes = memoryview(ids.tobytes()), pieces.column("length").to_numpy()
            ends = (4 * np.cumsum(sizes, dtype=np.int64)).tolist()
            crcs = [zlib.crc32(raw[low:high]) for low, high in zip([0, *ends], ends, strict=False)]
            columns = [pa.array(shards), *(pieces.column(c) for c in ("place", "doc_id", "piece")), pa.array(starts), pa.array(crcs, pa.int64()), pa.array(sizes.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "place", "doc_id", "piece", "start", "crc", "n"])

    schema = "shard int, place long, doc_id long, piece int, start long, crc long, n long"
    parts = spark.read.schema(BLOCKS).parquet(path).mapInArrow(run, schema)
    found = F.sort_array(F.collect_list(F.struct("piece", "crc", "n")))
    whole = parts.groupBy("shard", "place", "doc_id").agg(
        F.min("start").alias("start"), F.sum("n").alias("n_tokens"), found.alias("found")
    )
    joined = F.pandas_udf(_joined, "long")
    crc = F.when(F.size("found") == 1, F.col("found")[0]["crc"])
    # Only documents on a block's border have several pieces.
    one = whole.filter(F.size("found") == 1).withColumn("ids_crc32", crc)
    more = whole.filter(F.size("found") > 1).withColumn("ids_crc32", joined("found.crc", "found.n"))
    sizes = spark.read.schema(BLOCKS).parquet(path).groupBy("shard").agg(F.sum("n_ids").alias("shard_size"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", F.coalesce(F.sum("shard_size").over(before), F.lit(0)).alias("offset"))
    return (
        one.unionByName(more)
        .join(offsets, "shard")
        .select("doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")
    )


def _joined(crcs, sizes):
    import pandas as pd

    return pd.Series([_join_all(c, n) for c, n in zip(crcs, sizes, strict=True)], dtype="int64")


def _join_all(crcs, sizes) -> int:
    total = int(crcs[0])
    for crc, n in zip(crcs[1:], sizes[1:], strict=True):
        total = crc32_joined(total, int(crc), 4 * int(n))
    return total


def crc32_joined(first: int, second: int, length: int) -> int:
    """crc32 of two byte strings one after the other, from their crc32s and the length of the second.

    Appending zero bytes is linear: crc32(a + 0...) ^ crc32(0...) depends on crc32(a) alone and doubles by squaring.
    """
    step = [zlib.crc32(b"\0", 1 << bit) ^ zlib.crc32(b"\0", 0) for bit in range(32)]
    # ``zlib.crc32(x, c)`` continues from c; its linear part for one zero byte is ``step``.
    while length:
        if length & 1:
            first = _times(step, first)
        step = [_times(step, column) for column in step]
        length >>= 1
    return first ^ second


def _times(columns: list[int], value: int) -> int:
    out = 0
    for column in columns:
        if value & 1:
            out ^= column
        value >>= 1
    return out


def round_trip(docs: DataFrame, stage: Stage | None = None, tokenizer: str = TOKENIZER) -> DataFrame:
    """``digests`` of the files that ``write`` makes of ``docs`` in the shared folder.

    Null and empty texts hold only the end id. Repeated rows are written once each, next to each other; a null doc_id
    comes first. No rows give no blocks.
    """
    stage = stage or Stage(docs.sparkSession)
    path = f"{stage.folder}/planes"
    write(docs, path, tokenizer)
    return digests(docs.sparkSession, path)
