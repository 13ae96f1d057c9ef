"""Token ids on disk: fixed-size blocks of ids, transposed into planes and compressed.

A data set is a folder with two Parquet tables, both cut by ``shard``:

* ``kind=block``: ``shard, block, first, n_ids, payload``. The payload holds one block of
  ids: a header (magic, version, kind of plane, bytes per id, ids, planes), the length of
  each plane, and the planes, each compressed with zstandard. Blocks of a shard hold
  ``block_ids`` ids each, but for the last.
* ``kind=doc``: ``shard, doc_id, row, first, n_tokens``: where in its shard a document begins.

The rows of ``kind=block`` without ``payload`` are the chunk index: any run of ids is found
and read without the blocks around it. Shards follow ascending doc_id.

Spark's own writer commits the files, so a lost executor or a task run twice leaves each
block once, and any store that Spark can write to will do.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit.llm import encoding
from lakekit.llm.prefix import before

BLOCK_IDS = 1 << 16
LEVEL = 3
# Fixed values of the format.
MAGIC = b"IDPL"
VERSION = 1
BIT_PLANES, BYTE_PLANES = 0, 1
HEADER = struct.Struct("<4sBBBxII")

ROWS = (
    "kind string, shard long, block long, first long, n_ids long, payload binary, "
    "doc_id long, row long, n_tokens long"
)


def encode_block(ids: np.ndarray, width: int, planes: str = "best") -> bytes:
    """One block as bytes. ``planes``: bit, byte, or best, the shorter of the two."""
    kinds = {"bit": [BIT_PLANES], "byte": [BYTE_PLANES], "best": [BIT_PLANES, BYTE_PLANES]}[planes]
    return min((_encode(ids, width, kind) for kind in kinds), key=len)


def _encode(ids: np.ndarray, width: int, kind: int) -> bytes:
    cells = np.ascontiguousarray(ids.astype(f"<u{width}")).view(np.uint8).reshape(len(ids), width)
    planes = np.ascontiguousarray(cells.T)
    if kind == BIT_PLANES:
        planes = [np.packbits(plane >> bit & 1) for plane in planes for bit in range(8)]
    # No frame checksum: Parquet pages have their own.
    press = zstandard.ZstdCompressor(level=LEVEL)
    packed = [press.compress(np.ascontiguousarray(p).tobytes()) for p in planes]
    head = HEADER.pack(MAGIC, VERSION, kind, width, len(ids), len(packed))
    return head + struct.pack(f"<{len(packed)}I", *map(len, packed)) + b"".join(packed)


def decode_block(payload: bytes) -> np.ndarray:
    """The ids of a block, as unsigned 32-bit integers."""
    magic, version, kind, width, count, planes = HEADER.unpack_from(payload)
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a block of token ids, or of another version")
    sizes = struct.unpack_from(f"<{planes}I", payload, HEADER.size)
    at = HEADER.size + 4 * planes
    cells = np.zeros((width, count), dtype=np.uint8)
    for i, size in enumerate(sizes):
        plane = zstandard.decompress(payload[at : at + size], max_output_size=max(count, 1))
        at += size
        plane = np.frombuffer(plane, dtype=np.uint8)
        if kind == BIT_PLANES:
            cells[i // 8] |= np.unpackbits(plane, count=count) << (i % 8)
        else:
            cells[i] = plane
    return np.ascontiguousarray(cells.T).view(f"<u{width}").reshape(count).astype(np.uint32)


def write_ids(
    docs: DataFrame,
    path: str,
    *,
    tokenizer: str,
    end_id: int,
    block_ids: int = BLOCK_IDS,
    planes: str = "best",
) -> None:
    """Write the ids of every text in ascending doc_id order, each text with ``end_id``.

    ``docs`` has doc_id and text. A null text is empty and has the end id alone. A null
    doc_id comes first; rows that share an id stand by the order of a hash of their text
    and are told apart by ``row``; other columns are ignored. Without documents the data
    set is empty. Each task holds one block and one batch of texts.
    """
    spark = docs.sparkSession
    encoding.small_batches(spark)
    definition = encoding.shared_definition(spark, tokenizer)
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    # Texts are put in order before they are encoded, or Spark would encode them a first time
    # to find the bounds of the ranges.
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    ordered = texts.repartitionByRange(*order).sortWithinPartitions(*order)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        written = row = block = 0
        left = np.zeros(0, dtype=np.uint32)
        encoder = encoding.encoder_of(definition.value)
        width = encoder.width
        for batch in (part for whole in batches for part in encoding.slices(whole, "text")):
            found = encoder.encode(batch.column("text"))
            ids, counts = encoding.with_end(*found, end_id)
            firsts = written + len(left) + np.cumsum(counts) - counts
            n = batch.num_rows
            yield _rows(
                n,
                kind="doc",
                shard=shard,
                doc_id=batch.column("doc_id"),
                row=np.arange(row, row + n),
                first=firsts,
                n_tokens=counts,
            )
            row += n
            left = np.concatenate([left, ids])
            whole = len(left) // block_ids * block_ids
            for at in range(0, whole, block_ids):
                yield _block(shard, block, written, left[at : at + block_ids], width, planes)
                block, written = block + 1, written + block_ids
            left = left[whole:]
        if len(left):
            yield _block(shard, block, written, left, width, planes)

    (
        ordered.mapInArrow(blocks, ROWS)
        .write.partitionBy("kind")
        .option("compression", "none")
        .parquet(path)
    )


def _block(shard, block, first, ids, width, planes) -> pa.RecordBatch:
    payload = pa.array([encode_block(ids, width, planes)], pa.binary())
    return _rows(
        1, kind="block", shard=shard, block=block, first=first, n_ids=len(ids), payload=payload
    )


def _rows(n: int, **columns) -> pa.RecordBatch:
    """Rows of the mixed table; a column not given is null."""
    types = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    arrays, names = [], []
    for field in ROWS.split(", "):
        name, kind = field.split()
        value = columns.get(name)
        if value is None:
            array = pa.nulls(n, types[kind])
        elif isinstance(value, (pa.Array, np.ndarray)):
            array = value if isinstance(value, pa.Array) else pa.array(value, types[kind])
        else:
            array = pa.array([value] * n, types[kind])
        arrays.append(array)
        names.append(name)
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _read(spark: SparkSession, path: str, kind: str) -> DataFrame:
    return spark.read.schema(ROWS).parquet(path).filter(F.col("kind") == kind).drop("kind")


def chunk_index(spark: SparkSession, path: str) -> DataFrame:
    """``shard, block, first, n_ids, stored``: the blocks without reading them."""
    blocks = _read(spark, path, "block")
    return blocks.select("shard", "block", "first", "n_ids", F.length("payload").alias("stored"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, shard, row, first, start, n_tokens`` of a data set; ``start`` counts the ids
    of all documents before. One row per shard is summed in one task, no more."""
    docs = _read(spark, path, "doc").select("shard", "row", "doc_id", "first", "n_tokens")
    shards = docs.groupBy("shard").agg(F.sum("n_tokens").alias("_all"))
    shards = shards.select("shard", before("_all", [], ["shard"]).alias("_base"))
    placed = docs.join(shards, "shard")
    return placed.withColumn("start", F.col("_base") + F.col("first")).drop("_base")


def _block_ids(spark: SparkSession, path: str) -> int:
    """The ids of a full block, as the chunk index has it. Where no shard has two blocks the
    longest one will do, as every shard's documents lie in its first."""
    return _read(spark, path, "block").agg(F.max("n_ids")).first()[0] or 1


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """Read the files back: ``shard, row, block, length, crc`` for each part of a document
    that lies in one block, with the crc32 of its ids as unsigned 32-bit integers.

    Each block is decoded once, with the list of the documents in it; a document may
    cover any number of blocks.
    """
    block_ids = _block_ids(spark, path)
    docs = _read(spark, path, "doc")
    last = F.col("first") + F.col("n_tokens") - 1
    spans = F.sequence(F.floor(F.col("first") / block_ids), F.floor(last / block_ids))
    parts = docs.select("shard", "row", "first", last.alias("_last"), F.explode(spans).alias("block"))
    begin = F.greatest(F.col("first") - F.col("block") * block_ids, F.lit(0))
    end = F.least(F.col("_last") + 1 - F.col("block") * block_ids, F.lit(block_ids))
    part = F.struct("row", begin.alias("begin"), (end - begin).alias("length"))
    lists = parts.groupBy("shard", "block").agg(F.collect_list(part).alias("parts"))
    joined = _read(spark, path, "block").join(lists, ["shard", "block"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                raw = decode_block(batch.column("payload")[i].as_py()).astype("<u4").tobytes()
                rows, begins, lengths = batch.column("parts")[i].values.flatten()
                crcs = [
                    zlib.crc32(raw[4 * b : 4 * (b + n)])
                    for b, n in zip(begins.to_pylist(), lengths.to_pylist(), strict=True)
                ]
                n = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column("shard")[i].as_py()] * n, pa.int64()),
                        rows,
                        pa.array([batch.column("block")[i].as_py()] * n, pa.int64()),
                        lengths,
                        pa.array(crcs, pa.int64()),
                    ],
                    names=["shard", "row", "block", "length", "crc"],
                )

    shape = "shard long, row long, block long, length long, crc long"
    return joined.select("shard", "block", "payload", "parts").mapInArrow(digests, shape)


def read_checksums(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files."""
    found = read_segments(spark, path)
    ordered = F.sort_array(F.collect_list(F.struct("block", "length", "crc")))
    lists = found.groupBy("shard", "row").agg(ordered.alias("parts"))
    docs = read_documents(spark, path).join(lists, ["shard", "row"])

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column("parts")
            _, lengths, crcs = (x.to_pylist() for x in parts.flatten().flatten())
            ends = (np.asarray(parts.offsets) - parts.offsets[0].as_py()).tolist()
            totals = []
            for a, b in zip(ends, ends[1:], strict=False):
                total = crcs[a]
                for k in range(a + 1, b):
                    total = joined_crc32(total, crcs[k], 4 * lengths[k])
                totals.append(total)
            columns = [batch.column(c) for c in ("doc_id", "start", "n_tokens")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(totals, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    shape = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return docs.select("doc_id", "start", "n_tokens", "parts").mapInArrow(combine, shape)


# Fixed value: the polynomial of crc32, lowest power first in the highest bit.
POLYNOMIAL = 0xEDB88320


def _times(a: int, b: int) -> int:
    """The product of two polynomials modulo the polynomial of crc32."""
    product = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            product ^= b
        b = b >> 1 ^ POLYNOMIAL if b & 1 else b >> 1
    return product


@lru_cache(maxsize=4096)
def _shift(length: int) -> int:
    """The polynomial x to the power 8 * length."""
    power, square, left = 1 << 31, 1 << 23, length
    while left:
        if left & 1:
            power = _times(power, square)
        square = _times(square, square)
        left >>= 1
    return power


def joined_crc32(first: int, second: int, second_bytes: int) -> int:
    """The crc32 of two runs of bytes in a row, from the crc32 of each."""
    return _times(_shift(second_bytes), first) ^ second
