"""Packing of tokenized documents into sequences, in windows of a set mixture.

Each source is a queue of packets: a document's ids in its order, cut every
``sequence`` ids. In deficit round-robin a source is given its quantum of tokens in
every window and sends whole packets as long as its credit covers them; what is left
stays its credit for the next window. A packet that ends at token ``E`` of its queue is
therefore sent in window ``floor((E - 1) / quantum)``, which is a running total and
needs no loop: deficits are carried over windows and partitions by the total alone.
Windows, in each the sources in turn, make one stream that is cut every ``sequence``
ids. So every sequence but the last is full, and a window's share of a source is off by
less than one packet.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekit.llm import encoding
from lakekit.llm.prefix import running_totals, source_key
from lakekit.session import stage

SEQUENCE = 2048
WINDOW_SEQUENCES = 64
# Documents that share a bucket are sorted together; more documents, more buckets.
DOCS_PER_BUCKET = 5_000
LEAST_BUCKETS = 16


def pack(
    docs: DataFrame,
    *,
    tokenizer: str,
    end_id: int,
    sequence: int = SEQUENCE,
    window_sequences: int = WINDOW_SEQUENCES,
    weight: Column | None = None,
    digest: bool = False,
) -> DataFrame:
    """One row per piece: ``doc_id, source, start, length, doc_tokens, sequence_id, offset``,
    the packed ``ids`` of the piece and their ``width`` in bytes. With ``digest``, in place
    of the ids ``ids_crc32``: theirs as little-endian unsigned 32-bit integers.

    ``docs`` has doc_id, text and source. ``weight`` gives a source's target share
    from the column ``source`` (default: its own share of all tokens, so that all queues
    end in the same window). When a queue is empty the others fill its place. A null
    text is empty and has the end id alone; a null source is a queue of its own; repeated
    rows and ids are separate documents; other columns are ignored. No documents, no
    pieces.
    """
    text = encoding.text_or_empty()
    coded = encoding.tokenized(docs, ["doc_id", "source"], text, tokenizer, end_id)
    coded = coded.withColumn("_row", F.monotonically_increasing_id())
    ids = stage(coded, "packing")
    width = encoding.file_width(tokenizer)
    cuts = cut(ids.select("_row", "doc_id", "source", "n_tokens"), sequence, window_sequences, weight)
    lists = cuts.groupBy("_row").agg(
        F.sort_array(F.collect_list(F.struct("start", "length", "sequence_id", "offset"))).alias("pieces")
    )
    return _sliced(ids.join(lists, "_row"), width, digest)


def cut(
    lengths: DataFrame,
    sequence: int = SEQUENCE,
    window_sequences: int = WINDOW_SEQUENCES,
    weight: Column | None = None,
) -> DataFrame:
    """The pieces of documents of ``n_tokens`` ids each, by ``_row``: ``start, length,
    sequence_id, offset``. ``lengths`` is read several times: pass a stored frame."""
    lengths = lengths.withColumn("_key", source_key())
    buckets = max(LEAST_BUCKETS, lengths.count() // DOCS_PER_BUCKET)
    share = F.col("_size") if weight is None else weight * 1.0
    queues = lengths.groupBy("_key").agg(F.sum("n_tokens").alias("_size"), F.first("source").alias("source"))
    least = F.lit(1e-9)  # a queue without a share comes last, it is not left out
    queues = queues.select("_key", F.greatest(share.cast("double"), least).alias("_share"))
    total = queues.agg(F.sum("_share").alias("_total"))
    quantum = F.col("_share") / F.col("_total") * (sequence * window_sequences)
    queues = queues.join(F.broadcast(total)).select("_key", quantum.alias("_quantum"))

    order = [F.col("doc_id").asc_nulls_first(), "n_tokens", "_row"]
    hashed = F.pmod(F.xxhash64("doc_id", F.lit("queue")), F.lit(buckets))
    queued = running_totals(
        lengths.withColumn("_bucket", hashed), ["_key"], "_bucket", order, "n_tokens", "_queued"
    )
    # Packets: (first id, ids) of each cut document.
    steps = F.sequence(F.lit(0).cast("long"), F.col("n_tokens") - 1, F.lit(sequence).cast("long"))
    packets = queued.join(queues, "_key").select(
        "_row", "n_tokens", "_key", "_queued", "_quantum", F.explode(steps).alias("_first")
    )
    size = F.least(F.lit(sequence).cast("long"), F.col("n_tokens") - F.col("_first"))
    last = F.col("_queued") + F.col("_first") + size - 1
    packets = packets.select(
        "_row", "_key", "_first", size.alias("_size"), (F.col("_queued") + F.col("_first")).alias("_place"),
        F.floor(last / F.col("_quantum")).alias("_window"),
    )
    # The stream: windows, in a window the sources in turn, in a source its queue.
    placed = running_totals(packets, [], "_window", ["_key", "_place"], "_size", "_at")
    last = F.col("_at") + F.col("_size") - 1
    numbers = F.sequence(F.floor(F.col("_at") / sequence), F.floor(last / sequence))
    pieces = placed.withColumn("sequence_id", F.explode(numbers))
    begin = F.greatest(F.col("_at"), F.col("sequence_id") * sequence)
    end = F.least(F.col("_at") + F.col("_size"), (F.col("sequence_id") + 1) * sequence)
    return pieces.select(
        "_row",
        (F.col("_first") + begin - F.col("_at")).alias("start"),
        (end - begin).alias("length"),
        "sequence_id",
        (begin - F.col("sequence_id") * sequence).alias("offset"),
    )


def _sliced(joined: DataFrame, width: int, digest: bool) -> DataFrame:
    """Each piece with its own ids, or their crc32, taken from its document's."""
    shape = (
        "doc_id long, source string, start long, length long, doc_tokens long, "
        "sequence_id long, offset long, "
    ) + ("ids_crc32 long" if digest else "ids binary, width int")
    names = [field.split()[0] for field in shape.split(", ")]

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces = batch.column("pieces")
            counts = np.diff(np.asarray(pieces.offsets))
            at = pa.array(np.repeat(np.arange(batch.num_rows), counts))
            start, length, number, offset = pieces.flatten().flatten()
            raw = [x.as_buffer() for x in batch.column("ids")]
            spans = zip(at.to_pylist(), start.to_pylist(), length.to_pylist(), strict=True)
            parts = (memoryview(raw[i])[a * width : (a + n) * width] for i, a, n in spans)
            if digest:
                crcs = [zlib.crc32(encoding.unpack_ids(p, width).astype("<u4")) for p in parts]
                own = [pa.array(crcs, pa.int64())]
            else:
                own = [pa.array([bytes(p) for p in parts], pa.binary())]
                own.append(pa.array(np.full(len(at), width), pa.int32()))
            doc, source, tokens = (batch.column(c).take(at) for c in ("doc_id", "source", "n_tokens"))
            columns = [doc, source, start, length, tokens, number, offset, *own]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    ordered = joined.select(
        F.col("doc_id").cast("long"), F.col("source").cast("string"), "n_tokens", "ids", "pieces"
    )
    return ordered.mapInArrow(slices, shape)


def padded_length(length: int, sequence: int = SEQUENCE) -> int:
    """What a sequence of this many ids is padded to: nothing if it is a power of two."""
    return length if length & (length - 1) == 0 else sequence

