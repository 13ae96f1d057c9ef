"""Token ids of whole texts by a public tokenizer file, encoding each distinct word once.

The two byte-pair vocabularies in use never merge across white space, so the ids of
a text are the ids of its words in a row. Words are collected per batch with Arrow, each
distinct one is encoded by the tokenizers library, and the ids of the text are gathered
with numpy. Every shortcut is checked by counts; a text or word that does not fit it is
encoded whole by the library. Any other tokenizer file is applied plainly.

A null text counts as empty. The file's special strings are ordinary text here.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import lru_cache
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

# Distinct words kept between slices of text; with their ids some 40 MB.
CACHED_WORDS = 500_000
LEARNED_WORDS = 1 << 15
JOINED_WORDS = 4096
GATHERED_WORDS = 1 << 18
# Characters of a batch that are worked on at a time.
SLICE_BYTES = 8_000_000
# The same where words are hashed, which takes some 50 bytes for each character.
HASHED_BYTES = 1_000_000
# Bytes of a batch of blobs on its way to Spark, which holds a batch whole.
BATCH_BYTES = 1_000_000
# The white space a byte-level splitter knows, and the splitter of the
# vocabulary with word ends.
WHITE_SPACE = (
    r"[\t\n\x0b\x0c\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
WORD_END_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
TAIL_MARKS = ".,;:!?%$#*&|"


def id_width(vocabulary: int) -> int:
    """Bytes that hold any id of a vocabulary of this size."""
    return 2 if vocabulary <= 1 << 16 else 4


class Encoder:
    """``encode`` gives the ids of many texts in one array, and each text's count."""

    def __init__(self, definition: str):
        self._tokenizer = Tokenizer.from_str(definition)
        self._tokenizer.encode_special_tokens = True
        config = json.loads(definition)
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        self.width = id_width(max(vocabulary.values(), default=0) + 1)
        self._mode = _mode(config)
        self._marks = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        for piece, i in config["model"].get("vocab", {}).items() if self._mode else ():
            # A space before a word is written as this letter in byte-level pieces.
            self._marks[i] = piece.startswith("Ġ") if self._mode == "space" else piece.endswith("</w>")
        self._forget()

    def _forget(self, kept: np.ndarray | None = None) -> None:
        """Drop all words but those of the places ``kept``, with the ids that only they had."""
        if kept is None or not len(kept):
            self._known = pa.array([], pa.large_string())
            self._table = np.zeros((0, 2), dtype=np.int32)
            self._seen = np.zeros(0, dtype=np.int32)
            self._starts = np.zeros(1, dtype=np.int32)
            self._flat = np.zeros(0, dtype=np.uint32)
            return
        rows = self._table[kept]
        places = np.unique(rows[rows >= 0])
        ids, counts = _gather(
            self._flat, self._starts[:-1], np.diff(self._starts), places[:, None], np.arange(len(places) + 1)
        )
        self._known = self._known.take(pa.array(kept))
        self._table = np.where(rows >= 0, np.searchsorted(places, rows), -1).astype(np.int32)
        self._seen = self._seen[kept] // 2
        self._starts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        self._flat = ids

    def plain(self, texts: list[str]) -> list[np.ndarray]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=np.uint32) for e in found]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if self._mode is None or not len(texts):
            return _joined(self.plain(texts.to_pylist()))
        if len(self._known) > CACHED_WORDS:
            # Words met in one slice only are mostly rare ones.
            self._forget(np.flatnonzero(self._seen > 1))
        return self._by_space(texts) if self._mode == "space" else self._by_word(texts)

    # --- byte-level pieces: a word carries the one space before it ---

    def _by_space(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        # A space after white space may belong to the run before it: such texts go whole.
        odd = np.asarray(pc.match_substring_regex(texts, WHITE_SPACE + " "))
        whole = self.plain(texts.filter(pa.array(odd)).to_pylist())
        words = pc.split_pattern(texts.filter(pa.array(~odd)), " ")
        rows, bounds = self._parts(words, " ")
        if not len(words):
            return _interleave(odd, whole, np.zeros(0, np.uint32), np.zeros(0, np.int64))
        # The first word of a text has no space before it: its place is taken by own ids.
        first = self.plain(pc.list_element(words, 0).to_pylist())
        sizes = np.array([len(x) for x in first], dtype=np.int64)
        base, known = len(self._flat), len(self._starts) - 1
        starts = np.concatenate([self._starts[:-1], base + np.cumsum(sizes) - sizes])
        lengths = np.concatenate([np.diff(self._starts), sizes])
        rows[bounds[:-1], 0] = known + np.arange(len(first))
        rows[bounds[:-1], 1] = -1
        flat = np.concatenate([self._flat, *first])
        ids, counts = _gather(flat, starts, lengths, rows, bounds)
        return _interleave(odd, whole, ids, counts)

    # --- pieces with word ends: white space is dropped ---

    def _by_word(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        rows, bounds = self._parts(pc.ascii_split_whitespace(texts), "")
        return _gather(self._flat, self._starts[:-1], np.diff(self._starts), rows, bounds)

    def _parts(self, words: pa.Array, lead: str) -> tuple[np.ndarray, np.ndarray]:
        """Two places of ids for each word, -1 for none: its letters, and marks after them."""
        bounds = np.asarray(words.offsets).astype(np.int64)
        codes = words.flatten().dictionary_encode()
        at = pc.index_in(codes.dictionary, value_set=self._known)
        fresh = pc.is_null(at)
        at = np.array(pc.fill_null(at, -1))
        known = len(self._known)
        new = codes.dictionary.filter(fresh)
        for i in range(0, len(new), LEARNED_WORDS):
            self._learn(new.slice(i, LEARNED_WORDS), lead)
        at[np.asarray(fresh)] = known + np.arange(len(new))
        self._seen = np.concatenate([self._seen, np.zeros(len(new), dtype=np.int32)])
        self._seen[at] += 1
        return self._table[at][np.asarray(codes.indices)], bounds

    def _learn(self, words: pa.Array, lead: str) -> None:
        """Encode words not met before: their distinct parts, many in one call."""
        split = _letters_and_marks if lead else _lower_letters_and_marks
        pairs = [split(w) for w in words.to_pylist()]
        heads = dict.fromkeys(a for a, _ in pairs)
        plain, odd = [], []
        for w in heads:
            fits = w and not w[-1].isspace() if lead else w.isalpha()
            (plain if fits else odd).append(w)
        found: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        for i in range(0, len(plain), JOINED_WORDS):
            group = plain[i : i + JOINED_WORDS]
            (ids,) = self.plain([lead + " ".join(group)])
            marked = np.flatnonzero(self._marks[ids])
            if len(marked) != len(group):
                # A word came out in another way than expected: each on its own.
                found, sizes, plain, odd = [], [], [], list(heads)
                break
            found.append(ids)
            ends = {"append": len(ids)} if lead else {"prepend": -1}
            sizes.append(np.diff(marked, **ends))
        tails = [b for b in dict.fromkeys(b for _, b in pairs) if b]
        each = self.plain([lead + w for w in odd] + tails)
        sizes.append(np.array([len(x) for x in each], dtype=np.int64))
        first = len(self._starts) - 1
        place = {w: first + i for i, w in enumerate(plain + odd)}
        mark = {w: first + len(place) + i for i, w in enumerate(tails)}
        mark[""] = -1
        rows = np.empty((len(pairs), 2), dtype=np.int32)
        rows[:, 0] = [place[a] for a, _ in pairs]
        rows[:, 1] = [mark[b] for _, b in pairs]
        self._table = np.concatenate([self._table, rows])
        self._known = pa.concat_arrays([self._known, words])
        grown = np.cumsum(np.concatenate(sizes).astype(np.int64))
        self._starts = np.concatenate([self._starts, (self._starts[-1] + grown).astype(np.int32)])
        self._flat = np.concatenate([self._flat, *found, *each])


def _mode(config: dict) -> str | None:
    """Which shortcut holds for this file, if any."""
    split, model = config.get("pre_tokenizer") or {}, config["model"]
    if model.get("type") != "BPE" or model.get("dropout") or model.get("ignore_merges"):
        return None
    suffix = model.get("end_of_word_suffix")
    if split.get("type") == "ByteLevel":
        bare = not config.get("normalizer") and not suffix and split.get("use_regex", True)
        return "space" if bare and not split.get("add_prefix_space") else None
    steps = split.get("pretokenizers") or [{}]
    pattern = (steps[0].get("pattern") or {}).get("Regex")
    return "end" if suffix == "</w>" and pattern == WORD_END_SPLIT else None


def _letters_and_marks(word: str) -> tuple[str, str]:
    """Letters and a run of marks after them are split from each other in any case."""
    core = word.rstrip(TAIL_MARKS)
    return (core, word[len(core) :]) if core.isalpha() else (word, "")


def _lower_letters_and_marks(word: str) -> tuple[str, str]:
    """As above for a file that composes and lower-cases letters before it splits."""
    core = word.rstrip(TAIL_MARKS)
    if core.isascii():
        return (core.lower(), word[len(core) :]) if core.isalpha() else (word, "")
    plain = core.isalpha() and core.lower().isalpha() and is_normalized("NFC", core)
    return (core, word[len(core) :]) if plain else (word, "")


def _joined(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(x) for x in parts], dtype=np.int64)
    return (np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint32)), sizes


def _gather(flat, starts, sizes, rows, bounds) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the places in ``rows`` in a row, and how many lie between the bounds."""
    per_word = np.zeros(len(rows) + 1, dtype=np.int64)
    for column in rows.T:
        per_word[1:] += np.where(column >= 0, sizes[column], 0)
    ends = np.cumsum(per_word)
    out = np.empty(ends[-1], dtype=np.uint32)
    for a in range(0, len(rows), GATHERED_WORDS):
        b = min(a + GATHERED_WORDS, len(rows))
        parts = rows[a:b][rows[a:b] >= 0]
        lengths = sizes[parts]
        total = np.cumsum(lengths)
        at = np.repeat(starts[parts] - total + lengths, lengths)
        at += np.arange(len(at), dtype=at.dtype)
        out[ends[a] : ends[b]] = flat[at]
    return out, np.diff(ends[bounds])


def _interleave(odd, whole, ids, counts) -> tuple[np.ndarray, np.ndarray]:
    """Put the texts that were encoded whole back between the others."""
    if not len(whole):
        return ids, counts
    others = iter(np.split(ids, np.cumsum(counts)[:-1]) if len(counts) else [])
    own = iter(whole)
    return _joined([next(own) if x else next(others) for x in odd])


@lru_cache(maxsize=4)
def encoder_of(definition: str) -> Encoder:
    return Encoder(definition)


# Rows of an Arrow batch: with texts of a few kilobytes some megabytes.
BATCH_ROWS = 2000


def small_batches(spark: SparkSession) -> None:
    """Lower the session's rows per Arrow batch, whose default suits narrow rows, not texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def slices(batch: pa.RecordBatch, text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with a bounded amount of text, a longer text on its own."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0)).astype(np.int64)
    marks = np.flatnonzero(np.diff(np.cumsum(sizes) // most)) + 1
    for a, b in zip([0, *marks.tolist()], [*marks.tolist(), batch.num_rows], strict=True):
        if a < b:
            yield batch.slice(a, b - a)


def blob_batches(
    numbers: str, column: str, rows: Iterable[tuple[int, bytes]], most: int = BATCH_BYTES
) -> Iterator[pa.RecordBatch]:
    """Numbered blobs as Arrow batches of about ``most`` bytes; the rows are made on the way."""
    held: list[tuple[int, bytes]] = []
    size = 0

    def batch() -> pa.RecordBatch:
        names, blobs = zip(*held, strict=True)
        return pa.RecordBatch.from_pydict({numbers: pa.array(names, pa.int32()), column: pa.array(blobs, pa.binary())})

    for row in rows:
        held.append(row)
        size += len(row[1])
        if size >= most:
            yield batch()
            held.clear()
            size = 0
    if held:
        yield batch()


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The end id after each text's ids."""
    return np.insert(ids, np.cumsum(counts), end_id), counts + 1


def pack_ids(ids: np.ndarray, counts: np.ndarray, width: int) -> pa.Array:
    """Each text's ids as little-endian bytes."""
    raw = ids.astype(f"<u{width}")
    ends = np.concatenate([[0], np.cumsum(counts)]) * width
    return pa.Array.from_buffers(
        pa.large_binary(),
        len(counts),
        [None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(raw.tobytes())],
    ).cast(pa.binary())


def unpack_ids(raw: bytes, width: int) -> np.ndarray:
    return np.frombuffer(raw, dtype=f"<u{width}")


def shared_definition(spark: SparkSession, tokenizer: str) -> Broadcast:
    """The tokenizer file (a few megabytes, whatever the data), sent to the executors once."""
    with open(tokenizer, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


def tokenized(
    docs: DataFrame, keep: list[str], text: Column, tokenizer: str, end_id: int
) -> DataFrame:
    """The columns ``keep`` of ``docs``, ``n_tokens`` and the packed ``ids`` of each text."""
    spark = docs.sparkSession
    small_batches(spark)
    definition = shared_definition(spark, tokenizer)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(definition.value)
        for batch in (part for whole in batches for part in slices(whole, "_text")):
            found = encoder.encode(batch.column("_text"))
            ids, counts = with_end(*found, end_id)
            columns = [batch.column(c) for c in keep]
            columns += [pa.array(counts, pa.int64()), pack_ids(ids, counts, encoder.width)]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "n_tokens", "ids"])

    kept = docs.select(*keep)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return docs.select(*keep, text.alias("_text")).mapInArrow(encode, f"{fields}, n_tokens long, ids binary")


def file_width(tokenizer: str) -> int:
    """Bytes per packed id for a tokenizer file."""
    vocabulary = Tokenizer.from_file(tokenizer).get_vocab(with_added_tokens=True)
    return id_width(max(vocabulary.values(), default=0) + 1)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))
