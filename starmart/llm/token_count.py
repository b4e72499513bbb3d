"""Token counts under a unigram vocabulary, without building the tokens.

For each word an Aho-Corasick automaton enumerates the vocabulary pieces that end at every character, and dynamic
programming carries the best score and the number of pieces of the best way to that place. The rules are those of the
unigram tokenizers of the ``tokenizers`` library: spaces become the mark U+2581, one mark is put before a text that
does not begin with one, and words start at marks; of ways with the same score the one with the longer last piece
wins, a later one only if it is better; a character without a piece of its own may be taken as unknown at the lowest
score of the vocabulary less ten, and counts as its UTF-8 bytes where the vocabulary has byte pieces, else neighbouring
unknown characters count as one.

``estimated`` gives the pieces of a sentencepiece model unigram scores: the log of the share that a piece has, plus one,
of all its occurrences and those of the others in the words of the documents. The merge ranks of a BPE model are no such
scores. Control and byte pieces are no text there; byte pieces only stand for characters without a piece.

A null or empty text has no tokens. Counts do not depend on how texts are batched. Repeated rows are counted one by one;
other columns are never read; an empty table gives an empty result. The automaton is built once a worker, its size is
that of the vocabulary; the words a worker remembers are bounded by ``MAX_WORDS``.
"""

from __future__ import annotations

import math
from collections import Counter as Tally
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
UNKNOWN_PENALTY = 10.0
MAX_WORDS = 400_000
#: Words longer than this are counted but not remembered.
LONG_WORD = 64


def words(text: str | None) -> list[str]:
    """What follows each mark."""
    if not text:
        return []
    found = text.replace(" ", MARK).split(MARK)
    # What precedes the first mark is a word only if it is not empty: then a mark is put before it.
    return found if found[0] else found[1:]


class Counter:
    """Counts pieces of words under (piece, score) pairs."""

    def __init__(self, vocabulary: Iterable[tuple[str, float]], by_bytes: bool | None = None):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        if by_bytes is None:
            by_bytes = {f"<0x{b:02X}>" for b in range(256)} <= {piece for piece, _ in vocabulary}
        self.by_bytes = by_bytes
        #: Characters that are pieces: words of them need no unknown piece.
        self.single = frozenset(piece for piece, _ in vocabulary if len(piece) == 1)
        self.known: dict[str, int] = {}

    def count(self, text: str | None) -> int:
        return sum(map(self.word, words(text)))

    def word(self, word: str) -> int:
        """Pieces of a mark and ``word``."""
        pieces = self.known.get(word)
        if pieces is None:
            pieces = self.plain(MARK + word) if self.single.issuperset(MARK + word) else self.viterbi(MARK + word)
            if len(word) <= LONG_WORD:
                if len(self.known) >= MAX_WORDS:
                    self.known.clear()
                self.known[word] = pieces
        return pieces

    def plain(self, word: str) -> int:
        """``viterbi`` for words whose characters are all pieces, so that every place is reached by a piece."""
        score, pieces = [0.0], [0]
        for last, (length, value) in self.automaton.iter(word):
            start = last + 1 - length
            candidate = value + score[start]
            if last + 1 == len(score):
                score.append(candidate)
                pieces.append(pieces[start] + 1)
            elif candidate > score[-1]:
                score[-1], pieces[-1] = candidate, pieces[start] + 1
        return pieces[-1]

    def viterbi(self, word: str) -> int:
        """Pieces of the best way through ``word``."""
        size = len(word)
        score, pieces, unknown_end = [0.0] + [0.0] * size, [0] * (size + 1), [False] * (size + 1)
        done, single = 0, [False] * size
        reached = [True] + [False] * size
        for last, (length, value) in self.automaton.iter(word):
            end = last + 1
            # Matches come by their end, the longest first; what no piece covers in between is unknown.
            for at in range(done + 1, end):
                self._unknown(word, at, score, pieces, unknown_end, reached, single)
            done = max(done, end - 1)
            start = end - length
            candidate = value + score[start]
            if not reached[end] or candidate > score[end]:
                score[end], pieces[end], reached[end], unknown_end[end] = candidate, pieces[start] + 1, True, False
            if length == 1:
                single[last] = True
        for at in range(done + 1, size + 1):
            self._unknown(word, at, score, pieces, unknown_end, reached, single)
        return pieces[size]

    def _unknown(self, word, end, score, pieces, unknown_end, reached, single) -> None:
        """Offers the last character before ``end`` as unknown, after all pieces that end there."""
        if single[end - 1]:
            return
        candidate = self.unknown + score[end - 1]
        if not reached[end] or candidate > score[end]:
            if self.by_bytes:
                more = len(word[end - 1].encode("utf-8", "surrogatepass"))
            else:
                more = 0 if unknown_end[end - 1] else 1
            score[end], pieces[end], reached[end], unknown_end[end] = candidate, pieces[end - 1] + more, True, True


def vocabulary(path: str) -> list[tuple[str, float]]:
    """All pieces of a sentencepiece model and their scores, by id."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


@lru_cache(maxsize=2)
def counter_of(path: str) -> Counter:
    return Counter(vocabulary(path))


@lru_cache(maxsize=2)
def counter_over(scored: tuple[tuple[str, float], ...], by_bytes: bool) -> Counter:
    return Counter(scored, by_bytes)


def text_pieces(path: str) -> tuple[list[str], bool]:
    """Pieces of a sentencepiece model that stand for text, and whether it has byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    other = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)
    return [model.id_to_piece(i) for i in ids if not other(i)], any(map(model.is_byte, ids))


def estimated(docs: DataFrame, model_path: str) -> tuple[tuple[tuple[str, float], ...], bool]:
    """((piece, score), ...) from the occurrences of the model's pieces in all of ``docs``, and whether it has bytes."""
    pieces, by_bytes = text_pieces(model_path)

    def occurring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for i, piece in enumerate(pieces):
            automaton.add_word(piece, i)
        automaton.make_automaton()
        totals, seen = [0] * len(pieces), Tally()

        def add() -> None:
            for word, n in seen.items():
                for _, i in automaton.iter(MARK + word):
                    totals[i] += n
            seen.clear()

        for batch in batches:
            for text in batch.column("text").to_pylist():
                seen.update(words(text))
                if len(seen) > MAX_WORDS:
                    add()
        add()
        found = [i for i, n in enumerate(totals) if n]
        counts = pa.array([totals[i] for i in found], pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), counts], ["i", "n"])

    texts = docs.select(F.col("text").cast("string").alias("text"))
    # A row for each piece of the model at most.
    counted = texts.mapInArrow(occurring, "i int, n bigint").groupBy("i").agg(F.sum("n").alias("n")).collect()
    counts = {r["i"]: r["n"] for r in counted}
    total = sum(counts.values()) + len(pieces)
    return tuple((p, math.log((counts.get(i, 0) + 1) / total)) for i, p in enumerate(pieces)), by_bytes


def count_unigrams(docs: DataFrame, model_path: str) -> DataFrame:
    """``count_tokens`` under the model's pieces with scores estimated from ``docs``."""
    scored, by_bytes = estimated(docs, model_path)
    return counted_by(docs, lambda: counter_over(scored, by_bytes))


def count_tokens(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, n_chars (code points) of every row, under the model's own scores."""
    return counted_by(docs, lambda: counter_of(model_path))


def counted_by(docs: DataFrame, make: Callable[[], Counter]) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = make()
        for batch in batches:
            counts = np.fromiter(map(counter.count, batch.column("text").to_pylist()), np.int64, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts), batch.column("n_chars")], ["doc_id", "n_tokens", "n_chars"]
            )

    text = F.col("text").cast("string")
    rows = docs.select("doc_id", text.alias("text"), F.coalesce(F.length(text), F.lit(0)).cast("bigint").alias("n_chars"))
    return rows.mapInArrow(counted, f"doc_id {kind}, n_tokens bigint, n_chars bigint")
