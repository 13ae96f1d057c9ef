"""Scores of texts under a word bigram model with Katz backoff, learnt from the corpus.

``P(w | h) = d(c) c / (c(h) + 1)`` for a pair seen ``c`` times in training, and else
``a(h) P(w)``. Good-Turing discounts ``d`` hold for counts up to five; the one added to every
context's total is left to backing off, so that no context is without it. ``a(h)``
makes each context's probabilities sum to one exactly: what the seen words leave, over what
they leave of the unigram distribution. That is discounted in the same way, and what it
leaves is the probability of the unknown word.

Nothing of the model is held whole anywhere. Pairs are dealt by their second word into
partitions of bounded share (a frequent word is split by the first), so that counts of pairs
and words are found where the pairs are; a partition yields sums by document, and by
context what the context's weight needs. Those are dealt by context; there the weights are
computed and given to the tokens that backed off. Tables travel as packed arrays.

The pairs are shuffled once and read twice, for the counts of counts and for the scores;
that is why these passes are RDDs, whose shuffle files serve both.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import RDD, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.llm.encoding import HASHED_BYTES, blob_batches, slices, small_batches
from lakekit.llm.words import word_hashes

MOST_DISCOUNTED = 5
TRAINING_MODULUS, HELD_OUT = 7, 2
# Tokens of a task that are packed together.
FLUSHED_TOKENS = 3_000_000
# Pairs of a partition that are worked on at a time, at some 100 bytes each.
WORKED_PAIRS = 500_000
# Words of more than this share of a partition in a sample of texts are split.
SPLIT_SHARE = 0.25
SAMPLED_DOCS = 4000
FIXED_ONE = 2.0**32
START, END = np.uint64(0x5DEECE66D1234567), np.uint64(0x2545F4914F6CDD1D)
RESULT = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double"
)


def held_out(doc_id: int | None) -> bool:
    text = "" if doc_id is None else str(doc_id)
    return zlib.crc32(text.encode()) % TRAINING_MODULUS == HELD_OUT


def discounts(counts: np.ndarray) -> np.ndarray:
    """``d(0) .. d(5)`` from the numbers of types seen once, twice, .. six times.

    Good-Turing with Katz's correction; if counts are too few for it to lie between 0 and 1,
    absolute discounting.
    """
    k = MOST_DISCOUNTED
    n = np.concatenate([[0.0], counts[: k + 1].astype(float)])
    d = np.ones(k + 1)
    if n[1:].min() > 0:
        top = (k + 1) * n[k + 1] / n[1]
        r = np.arange(1, k + 1)
        ratio = (r + 1) * n[2:] / n[1:-1] / r
        if top < 1:
            d[1:] = (ratio - top) / (1 - top)
    if not ((d[1:] > 0) & (d[1:] < 1)).all():
        step = n[1] / (n[1] + 2 * n[2]) if n[1] > 0 and n[2] > 0 else 0.5
        d[1:] = 1 - step / np.arange(1, k + 1)
    return d


def _discounted(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    """``d(c) c`` for each count."""
    return counts * np.where(counts <= MOST_DISCOUNTED, d[np.minimum(counts, MOST_DISCOUNTED)], 1.0)


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where a new combination begins in sorted columns."""
    if not len(columns[0]):
        return np.zeros(0, dtype=np.int64)
    fresh = np.zeros(len(columns[0]), dtype=bool)
    fresh[0] = True
    for column in columns:
        fresh[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(fresh)


def _narrow(x: np.ndarray) -> np.ndarray:
    top = int(x.max()) if len(x) else 0
    return x.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32)


def _planes(x):
    """An array for compression: steps in place of sorted numbers, and the first bytes of all
    entries, then the second ones and so on, as the high bytes are mostly alike."""
    if not isinstance(x, np.ndarray) or x.dtype.itemsize == 1:
        return x
    rising = x.dtype.kind in "iu" and len(x) > 1 and bool((x[1:] >= x[:-1]).all())
    steps = np.diff(x, prepend=x.dtype.type(0)) if rising else x
    return _Planes((x.dtype.str, rising, steps.view(np.uint8).reshape(-1, x.dtype.itemsize).T.tobytes()))


class _Planes(tuple):
    """What stands for an array: its type, whether it holds steps, its bytes."""

    def array(self) -> np.ndarray:
        dtype, rising, raw = np.dtype(self[0]), self[1], np.frombuffer(self[2], np.uint8)
        x = np.ascontiguousarray(raw.reshape(dtype.itemsize, -1).T).view(dtype).ravel()
        return np.cumsum(x, dtype=dtype) if rising else x


def _shut(kind: str, value: tuple) -> bytes:
    """What travels between stages, compressed more than shuffle files would be."""
    return zstandard.compress(pickle.dumps((kind, tuple(map(_planes, value))), 5), 3)


def _opened(packed: bytes) -> tuple:
    kind, value = pickle.loads(zstandard.decompress(packed))
    return kind, tuple(x.array() if isinstance(x, _Planes) else x for x in value)


def _fixed(x: np.ndarray) -> np.ndarray:
    """Sums of logarithms as whole numbers of ``2**-32``: they travel in five bytes, and add up to
    the same in any order."""
    return np.rint(x * FIXED_ONE).astype(np.int64)


# --- packed pairs ---------------------------------------------------------------


def _pack_pairs(task: int, first: np.ndarray, second: np.ndarray, doc: np.ndarray) -> tuple:
    """Pairs sorted by second and first word; each word once, small numbers for the rest."""
    order = np.lexsort((doc, first, second))
    first, second, doc = first[order], second[order], doc[order]
    types = _runs(second, first)
    words = _runs(second[types])
    firsts, at = np.unique(first[types], return_inverse=True)
    return (
        task,
        second[types][words],
        _narrow(np.diff(np.append(words, len(types)))),
        firsts,
        _narrow(at),
        _narrow(np.diff(np.append(types, len(first)))),
        _narrow(doc),
    )


def _slice(packed: tuple, low: int, high: int) -> tuple:
    """The packed pairs of the words from ``low`` to before ``high``."""
    task, words, per_word, firsts, at, per_type, doc = packed
    a = int(np.searchsorted(words, np.uint64(low)))
    b = int(np.searchsorted(words, np.uint64(high))) if high < 1 << 64 else len(words)
    c, d = int(per_word[:a].sum()), int(per_word[:b].sum())
    e, f = int(per_type[:c].sum()), int(per_type[:d].sum())
    return task, words[a:b], per_word[a:b], firsts, at[c:d], per_type[c:d], doc[e:f]


def _unpack_pairs(packed: list[tuple]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``first, second, doc`` of all pairs of a partition, sorted by second and first, in runs of
    words. As words are hashes, equal ranges of them have about as many pairs."""
    runs = sum(len(x[-1]) for x in packed) // WORKED_PAIRS + 1
    edges = [(i << 64) // runs for i in range(runs + 1)]
    for low, high in zip(edges, edges[1:], strict=False):
        found = [_slice(x, low, high) for x in packed]
        if any(len(x[-1]) for x in found):
            yield _unpacked(found)


def _unpacked(packed: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    parts = []
    for task, words, per_word, firsts, at, per_type, doc in packed:
        per_type = per_type.astype(np.int64)
        second = np.repeat(np.repeat(words, per_word.astype(np.int64)), per_type)
        parts.append((np.repeat(firsts[at], per_type), second, doc.astype(np.int64) + (task << 32)))
    first, second, doc = (np.concatenate(x) for x in zip(*parts, strict=True))
    del parts
    order = np.lexsort((first, second))
    first, second = first[order], second[order]
    return first, second, doc[order]


def _texts_to_pairs(docs: DataFrame, parts: int, split: np.ndarray) -> RDD:
    """``(partition, ("pairs", ..) or ("docs", ..))``, dealt to their partitions.

    A document's number is its task's and its place there, twice, plus 1 if it is held out.
    """
    small_batches(docs.sparkSession)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        held: list[tuple] = []
        ids, sizes, waiting, numbered = [], [], 0, 0

        def rows() -> Iterator[tuple[int, bytes]]:
            second, doc = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            # The word before, or a start: texts are whole, so one follows each end.
            first = np.concatenate([[START], second[:-1]]).astype(np.uint64)
            first[first == END] = START
            part = _part(first, second, parts, split)
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            del part
            for p in np.flatnonzero(np.diff(cuts)):
                at = order[cuts[p] : cuts[p + 1]]
                yield int(p), _shut("pairs", _pack_pairs(task, first[at], second[at], doc[at]))

        for batch in (x for whole in batches for x in slices(whole, "text", HASHED_BYTES)):
            words, counts = word_hashes(batch.column("text"))
            doc_ids = batch.column("doc_id").to_pylist()
            number = 2 * (numbered + np.arange(len(counts))) + [held_out(i) for i in doc_ids]
            number = number.astype(np.uint32)
            # An end after each text's words.
            second = np.insert(words, np.cumsum(counts), END)
            held.append((second, np.repeat(number, counts + 1)))
            ids += doc_ids
            sizes.append(counts + 1)
            numbered += len(counts)
            waiting += len(second)
            if waiting >= FLUSHED_TOKENS:
                yield from blob_batches("part", "packed", rows())
                waiting = 0
        if held:
            yield from blob_batches("part", "packed", rows())
        if ids:
            packed = _shut("docs", (task, ids, np.concatenate(sizes)))
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([task % parts], pa.int32()), "packed": pa.array([packed], pa.binary())}
            )

    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(pack, "part int, packed binary")
    return rows.rdd.map(lambda r: (r["part"], bytes(r["packed"]))).partitionBy(parts, int)


def _part(first: np.ndarray, second: np.ndarray, parts: int, split: np.ndarray) -> np.ndarray:
    key = second >> np.uint64(20)
    hot = np.flatnonzero(np.isin(second, split))
    key[hot] = (second[hot] ^ (first[hot] >> np.uint64(7)) ^ first[hot]) >> np.uint64(20)
    key %= np.uint64(parts)
    return key.astype(np.int32)


def _partition(rows: Iterator) -> tuple[list, list]:
    pairs, docs = [], []
    for _, packed in rows:
        kind, value = _opened(packed)
        (pairs if kind == "pairs" else docs).append(value)
    return pairs, docs


def _counted(pairs: list[tuple], split: dict[int, int]) -> Iterator[tuple[np.ndarray, ...]]:
    """By runs of words: ``first, second`` of the types, the documents of all pairs, how many of
    them each type has, the types' training counts and their words'; the words, their counts."""
    for first, second, doc in _unpack_pairs(pairs):
        types = _runs(second, first)
        per_type = np.diff(np.append(types, len(first)))
        count = np.add.reduceat(((doc & 1) == 0).astype(np.int64), types)
        first, second = first[types], second[types]
        words = _runs(second)
        word_count = np.add.reduceat(count, words)
        names = second[words]
        for i in np.flatnonzero(np.isin(names, np.array(list(split), dtype=np.uint64))):
            word_count[i] = split[int(names[i])]
        of_type = np.repeat(word_count, np.diff(np.append(words, len(types))))
        yield first, second, doc, per_type, count, of_type, names, word_count


def _summed(keys: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct keys in ascending order, and the sums of each column by them."""
    names, of = np.unique(keys, return_inverse=True)
    return names, *(np.bincount(of, x, minlength=len(names)) for x in columns)


def _joined(parts: list[tuple]) -> Iterator[np.ndarray]:
    """Column by column; the parts are given up."""
    columns = list(zip(*parts, strict=True))
    parts.clear()
    while columns:
        yield np.concatenate(columns.pop(0))


def _counts_of_counts(counts: np.ndarray) -> np.ndarray:
    return np.bincount(np.clip(counts, 0, MOST_DISCOUNTED + 2), minlength=MOST_DISCOUNTED + 3)[1:-1]


# --- the model -------------------------------------------------------------------


def _split_words(docs: DataFrame, parts: int) -> dict[int, int]:
    """Words to be split over partitions, with their training counts over all texts.

    Which words, is found in a sample of texts and only says where pairs are
    counted; at most a few for each partition. Their counts cover every text.
    """
    small_batches(docs.sparkSession)
    sample = docs.select("text").orderBy(F.xxhash64("doc_id", "text")).limit(SAMPLED_DOCS)
    least = SPLIT_SHARE / parts

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (x for whole in batches for x in slices(whole, "text", HASHED_BYTES)):
            words, n = np.unique(word_hashes(batch.column("text"))[0], return_counts=True)
            yield pa.RecordBatch.from_pydict({"w": words.view(np.int64), "n": n.astype(np.int64)})

    counted = sample.mapInArrow(frequent, "w long, n long").groupBy("w").agg(F.sum("n").alias("n"))
    total = counted.agg(F.sum("n")).first()[0] or 0
    found = counted.filter(F.col("n") > least * total).select("w").collect()
    split = np.array([r["w"] for r in found], dtype=np.int64).view(np.uint64)
    split = np.sort(np.append(split, END))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(split), dtype=np.int64)
        for batch in (x for whole in batches for x in slices(whole, "text", HASHED_BYTES)):
            words, counts = word_hashes(batch.column("text"))
            training = np.array([not held_out(i) for i in batch.column("doc_id").to_pylist()], dtype=bool)
            words = words[np.repeat(training, counts)]
            at = np.minimum(np.searchsorted(split, words), len(split) - 1)
            total += np.bincount(at[split[at] == words], minlength=len(split))
            total[np.searchsorted(split, END)] += training.sum()
        yield pa.RecordBatch.from_pydict({"w": split.view(np.int64), "n": total})

    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(exact, "w long, n long")
    sums = rows.groupBy("w").agg(F.sum("n").alias("n")).collect()
    return {r["w"] % (1 << 64): r["n"] for r in sums} or {int(END): 0}


def score(docs: DataFrame) -> DataFrame:
    """The columns of ``RESULT`` for every document, learnt from those not held out.

    ``docs`` has doc_id and text; other columns are ignored. Null, empty and blank texts
    have the end token alone. Repeated rows are separate documents; a null doc_id counts
    as the empty text when the held-out ones are chosen. Without training documents every
    token is unknown and of probability 1. No documents, no rows.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    split = _split_words(docs, parts)
    names = np.array(sorted(split), dtype=np.uint64)
    dealt = _texts_to_pairs(docs, parts, names)

    def statistics(rows: Iterator) -> Iterator:
        pairs, _ = _partition(rows)
        for _, _, _, _, count, _, words, word_count in _counted(pairs, split):
            own = ~np.isin(words, names)
            yield (
                _counts_of_counts(count),
                _counts_of_counts(word_count[own]),
                int(count.sum()),
                int((word_count[own] > 0).sum()),
            )

    zero = (np.zeros(MOST_DISCOUNTED + 1, np.int64),) * 2 + (0, 0)
    found = dealt.mapPartitions(statistics).fold(zero, lambda a, b: tuple(x + y for x, y in zip(a, b, strict=True)))
    pair_counts, word_counts, tokens, vocabulary = found
    frequent = np.array(list(split.values()), dtype=np.int64)
    word_counts = word_counts + _counts_of_counts(frequent)
    vocabulary += int((frequent > 0).sum())
    pair_d, word_d = discounts(pair_counts), discounts(word_counts)
    # What discounting takes from the words is the unknown word's, one count at least.
    taken = float((np.arange(1, MOST_DISCOUNTED + 1) * (1 - word_d[1:]) * word_counts[:-1]).sum())
    unknown = max(taken, 1.0)
    scale = tokens - taken + unknown

    def unigram(counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, _discounted(counts, word_d), unknown) / max(scale, 1.0)

    def sums(rows: Iterator) -> Iterator:
        pairs, about = _partition(rows)
        for value in about:
            yield int(value[0]) % parts, _shut("docs", value)
        if not pairs:
            return
        by_doc, by_context, backed = [], [], []
        for first, second, doc, per_type, count, word_count, _, _ in _counted(pairs, split):
            seen = count > 0
            p1 = unigram(word_count)
            value = np.log10(np.where(seen, _discounted(count, pair_d), p1))
            # Each word is the context of the next one and gives that its total.
            value -= np.where(second == END, 0.0, np.log10(word_count + 1.0))
            base = np.log10(word_count + 1.0)
            weights = (np.repeat(x, per_type) for x in (value, base, (word_count > 0).astype(float)))
            by_doc.append(_summed(doc, *weights))
            # By context: what discounts leave of its pairs, and the unigram share of its words.
            left = (count - _discounted(count, pair_d))[seen]
            by_context.append(_summed(first[seen], left, p1[seen]))
            backed.append((np.repeat(first[~seen], per_type[~seen]), doc[np.repeat(~seen, per_type)]))
        pairs.clear()
        at, *by_doc = _summed(*_joined(by_doc))
        by_doc = [_fixed(by_doc[0]), _fixed(by_doc[1]), _narrow(by_doc[2])]
        tasks = at >> 32
        for task in np.unique(tasks).tolist():
            rows_ = tasks == task
            number = (at[rows_] & 0xFFFFFFFF).astype(np.uint32)
            yield task % parts, _shut("sums", (task, number, *(x[rows_] for x in by_doc)))
        contexts, rest, share = _summed(*_joined(by_context))
        asked, who = _joined(backed)
        order = np.lexsort((who, asked))
        asked, who = asked[order], who[order]
        to = _deal(contexts, parts)
        asked_to = _deal(asked, parts)
        for p in np.unique(np.concatenate([to, asked_to])).tolist():
            mine, theirs = to == p, asked_to == p
            yield p, _shut("contexts", (contexts[mine], rest[mine], share[mine], asked[theirs], who[theirs]))

    summed = dealt.mapPartitions(sums).partitionBy(parts, int)

    def weights(rows: Iterator) -> Iterator:
        tables, asked = [], []
        for _, packed in rows:
            kind, value = _opened(packed)
            if kind == "contexts":
                tables.append(value[:3])
                asked.append(value[3:])
            else:
                yield int(value[0]) % parts, packed
        if not asked:
            return
        context, who = (np.concatenate(x) for x in zip(*asked, strict=True))
        all_contexts, rest, share = (np.concatenate(x) for x in zip(*tables, strict=True))
        names, of = np.unique(all_contexts, return_inverse=True)
        rest = 1.0 + np.bincount(of, rest, minlength=len(names))
        share = 1.0 - np.bincount(of, share, minlength=len(names))
        # The weight times the context's total, which its word has taken off already.
        weight = np.append(np.log10(rest / share), 0.0)
        at = np.minimum(np.searchsorted(names, context), max(len(names) - 1, 0))
        known = names[at] == context if len(names) else np.zeros(len(context), dtype=bool)
        value = np.where(known, weight[at], 0.0)
        docs_, of = np.unique(who, return_inverse=True)
        total = np.bincount(of, value, minlength=len(docs_))
        tasks = docs_ >> 32
        for task in np.unique(tasks).tolist():
            mine = tasks == task
            number = (docs_[mine] & 0xFFFFFFFF).astype(np.uint32)
            zeros = np.zeros(mine.sum(), dtype=np.uint8)
            yield task % parts, _shut("sums", (task, number, _fixed(total[mine]), zeros, zeros))

    def results(rows: Iterator) -> Iterator:
        about, parts_ = {}, {}
        for _, packed in rows:
            kind, value = _opened(packed)
            if kind == "docs":
                about[value[0]] = value[1:]
            else:
                parts_.setdefault(value[0], []).append(value[1:])
        for task, (ids, sizes) in about.items():
            total = np.zeros((3, len(ids)), dtype=np.int64)
            for number, *columns in parts_.get(task, []):
                for row, column in zip(total, columns, strict=True):
                    np.add.at(row, number >> 1, column.astype(np.int64))
            start = np.log10(starts + 1.0)
            base = total[1] / FIXED_ONE - sizes * np.log10(tokens + vocabulary + 1.0)
            for i, doc_id in enumerate(ids):
                yield (
                    doc_id,
                    held_out(doc_id),
                    int(sizes[i]),
                    int(total[2, i]),
                    tokens,
                    float(base[i]),
                    float(total[0, i] / FIXED_ONE - start),
                )

    starts = split[int(END)]
    placed = summed.mapPartitions(weights).partitionBy(parts, int).mapPartitions(results)
    return spark.createDataFrame(placed, RESULT)


def _deal(words: np.ndarray, parts: int) -> np.ndarray:
    return ((words >> np.uint64(13)) % np.uint64(parts)).astype(np.int64)
