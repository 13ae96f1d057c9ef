"""Token counts under a vocabulary of pieces, by dynamic programming shared over a trie.

Under a unigram vocabulary a word is cut so that the sum of its pieces' scores is greatest, of
equal sums the one with fewest pieces. The scores of a BPE file are ranks of merges and mean
nothing as a sum; there the pieces are those that the merges leave. Merges cross no border of
the outcome, so a cut is the outcome if and only if every two neighbours, merged on
their own, stay as they are. A prefix then has one last piece, which follows from
those of the shorter prefixes.

The distinct words of a slice of texts, in order,
are a walk through their trie: the best scores or the last piece of a prefix are computed when the walk
first enters it and stand on a stack for all words below it. The count at a word's
end is stored, and the documents add up the counts of their words.

Nothing is shuffled: a document is counted where it is read. Words that recur keep
their counts between slices, in a table of bounded size.

A character that no piece covers costs one piece per UTF-8 byte, in a sum of scores each below
every score.
Null, empty and blank texts have 0 words and 0 tokens; repeated rows are counted alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from lakekit.llm.encoding import slices, small_batches

KEPT_WORDS = 500_000
# Fixed value: the mark that begins a word's first piece.
WORD_MARK = "▁"
UNCOVERED = -10.0
# So many pairs of neighbours are remembered.
KEPT_PAIRS = 1_000_000


class Ranks(dict):
    """Pieces of a BPE vocabulary; of two merges the one with the higher score comes first.
    ``stays`` remembers which neighbours the merges leave as they are."""

    def __init__(self, pieces):
        super().__init__(pieces)
        self.stays: dict[tuple[str, str], bool] = {}


def read_pieces(model_file: str) -> dict[str, float]:
    """The pieces of a sentencepiece file and their scores, without control, unknown and
    byte pieces; as :class:`Ranks` if the file is one of merges."""
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

    with open(model_file, "rb") as file:
        trainer = sentencepiece_model_pb2.ModelProto.FromString(file.read()).trainer_spec
    kind = Ranks if trainer.model_type == trainer.BPE else dict
    model = SentencePieceProcessor(model_file=model_file)
    ids = range(model.get_piece_size())
    plain = (
        i
        for i in ids
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    )
    return kind((model.id_to_piece(i), model.get_score(i)) for i in plain)


def trie_counts(words: list[str], scores: dict[str, float]) -> dict[str, int]:
    """The token count of each distinct word."""
    if isinstance(scores, Ranks):
        return _merged_counts(words, scores)
    longest = max(map(len, scores), default=1)
    below = min(scores.values(), default=0.0) + UNCOVERED
    get = scores.get
    # The stack: best score and count of each prefix of the word in hand, mark included.
    best, count = [0.0], [0]
    last, found = "", {}
    for word in sorted(set(words)):
        text = WORD_MARK + word
        shared = _shared(last, text)
        del best[shared + 1 :], count[shared + 1 :]
        for end in range(shared + 1, len(text) + 1):
            letter = text[end - 1]
            n_bytes = len(letter.encode("utf-8", "surrogatepass"))
            top, pieces = best[end - 1] + below * n_bytes, count[end - 1] + n_bytes
            for start in range(max(0, end - longest), end):
                score = get(text[start:end])
                if score is None:
                    continue
                score += best[start]
                if score > top or (score == top and count[start] + 1 < pieces):
                    top, pieces = score, count[start] + 1
            best.append(top)
            count.append(pieces)
        found[word] = count[-1]
        last = text
    return found


def _merged(text: str, ranks: Ranks) -> list[str]:
    """The pieces that the merges leave of a short text."""
    parts = list(text)
    while len(parts) > 1:
        found = [(ranks[a + b], -i) for i, (a, b) in enumerate(pairwise(parts)) if a + b in ranks]
        if not found:
            break
        at = -max(found)[1]
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


def _merged_counts(words: list[str], ranks: Ranks) -> dict[str, int]:
    longest = max(map(len, ranks), default=1)
    stays = ranks.stays
    if len(stays) > KEPT_PAIRS:
        stays.clear()
    # The stack: last piece and count of each prefix of the word in hand, mark included.
    ends, count = [""], [0]
    last, found = "", {}
    for word in sorted(set(words)):
        text = WORD_MARK + word
        shared = _shared(last, text)
        del ends[shared + 1 :], count[shared + 1 :]
        for end in range(shared + 1, len(text) + 1):
            for start in range(max(0, end - longest), end):
                piece = text[start:end]
                if piece not in ranks and start < end - 1:
                    continue
                before = ends[start]
                stay = stays.get((before, piece))
                if stay is None:
                    stay = _merged(before + piece, ranks) == ([before, piece] if before else [piece])
                    stays[before, piece] = stay
                if stay:
                    break
            ends.append(piece)
            count.append(count[start] + (1 if piece in ranks else len(piece.encode("utf-8", "surrogatepass"))))
        found[word] = count[-1]
        last = text
    return found


def _shared(a: str, b: str) -> int:
    """The length of the longest common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while low < high:
        middle = (low + high + 1) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class _Words:
    """Counts of the words met so far."""

    def __init__(self, scores: dict[str, float]):
        self._scores = scores
        self._known = pa.array([], pa.large_string())
        self._counts = np.zeros(0, dtype=np.int64)
        self._seen = np.zeros(0, dtype=np.int32)

    def counts(self, words: pa.Array) -> np.ndarray:
        if len(self._known) > KEPT_WORDS:
            kept = np.flatnonzero(self._seen > 1)
            self._known = self._known.take(pa.array(kept))
            self._counts, self._seen = self._counts[kept], self._seen[kept] // 2
        at = pc.index_in(words, value_set=self._known)
        fresh = np.asarray(pc.is_null(at))
        at = np.array(pc.fill_null(at, -1))
        new = words.filter(pa.array(fresh))
        if len(new):
            names = new.to_pylist()
            found = trie_counts(names, self._scores)
            at[fresh] = len(self._known) + np.arange(len(new))
            self._known = pa.concat_arrays([self._known, new])
            self._counts = np.concatenate([self._counts, [found[w] for w in names]])
            self._seen = np.concatenate([self._seen, np.zeros(len(new), dtype=np.int32)])
        self._seen[at] += 1
        return self._counts[at]


@lru_cache(maxsize=2)
def _words(model_file: str) -> _Words:
    return _Words(read_pieces(model_file))


def count_tokens(docs: DataFrame, *, model_file: str) -> DataFrame:
    """``doc_id, n_words, n_tokens`` of every whole text; other columns are ignored.

    ``model_file`` must be readable on the executors (a few hundred kilobytes).
    """
    small_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _words(model_file)
        for batch in (part for whole in batches for part in slices(whole, "text")):
            texts = pc.fill_null(batch.column("text").cast(pa.large_string()), "")
            split = pc.ascii_split_whitespace(texts)
            bounds = np.asarray(split.offsets).astype(np.int64)
            codes = split.flatten().dictionary_encode()
            known = codes.dictionary
            per_word = np.where(np.asarray(pc.binary_length(known)) > 0, table.counts(known), 0)
            real = np.asarray(pc.binary_length(known)) > 0
            at = np.asarray(codes.indices)
            tokens = np.concatenate([[0], np.cumsum(per_word[at])])
            words = np.concatenate([[0], np.cumsum(real[at])])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(np.diff(words[bounds]), pa.int64()),
                    pa.array(np.diff(tokens[bounds]), pa.int64()),
                ],
                names=["doc_id", "n_words", "n_tokens"],
            )

    return docs.select("doc_id", "text").mapInArrow(count, "doc_id long, n_words long, n_tokens long")
