"""Packing: documents as token ids in sequences of a fixed length, by sum-of-squares online placement.

A document is its token ids and one closing id. Full sequences are cut off its front; what remains is placed whole into
a partly filled sequence so that the sum, over fill levels, of the squared number of sequences at that level becomes
smallest. An array holds the number of sequences at each level, so a placement looks at levels, not at sequences.
The rule keeps few partly filled sequences open. When a task ends, or holds ``MAX_OPEN`` of them, they are closed:
the emptiest are cut up to fill the fullest, and the last rest is cut into powers of two, which need no padding.

Each task packs the rows of its input split, in their order; nothing shuffles. Memory holds one batch of texts and the
open sequences. Sequence ids join the task's number in its job with a count, so a task run again gives the same ids
for the same rows.

A null or empty text is the closing id alone. Repeated rows are packed one by one. Null ids are carried. Other columns
are never read. An empty table gives no pieces.
"""

from __future__ import annotations

import string
import struct
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LENGTH = 2048
END_ID = 1
#: Open sequences a task holds before it closes them; 4,096 hold at most 8 million ids.
MAX_OPEN = 4096
#: Encoded words a worker remembers.
MAX_WORDS = 600_000
#: Texts that go through the tokenizer together, in characters.
GROUP_CHARS = 1 << 21
SEQUENCES_PER_TASK = 1 << 40
SIGNS = string.punctuation.encode()
#: Byte-level spelling: printable bytes stand for themselves, the others for 256, 257, ... in order.
PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
SPELLING = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in PRINTABLE)}


class WordEncoder:
    """Token ids of texts under a tokenizer that drops white space, lowers letters and never joins what it separates:
    runs of letters, single digits and runs of other signs.

    Words between ASCII white space are remembered as little-endian unsigned 32-bit ids. A new word of Latin letters,
    with signs after it or not, is put together from its two runs; any other goes through the tokenizer as a whole.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.words: dict[bytes, bytes] = {}
        self.runs: dict[bytes, bytes] = {b"": b""}

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of each text, some texts at a time."""
        group: list[list[bytes]] = []
        chars = 0
        for text in texts:
            group.append((text or "").encode("utf-8", "surrogatepass").split())
            chars += len(text or "")
            if chars >= GROUP_CHARS:
                yield from self._encode(group)
                group, chars = [], 0
        yield from self._encode(group)

    def _encode(self, group: list[list[bytes]]) -> Iterator[bytes]:
        if len(self.words) > MAX_WORDS:
            self.words.clear()
            self.runs = {b"": b""}
        new = {w for words in group for w in words} - self.words.keys()
        rest = []
        for word in new:
            letters = word.rstrip(SIGNS)
            signs = word[len(letters) :]
            if b"<" in signs:  # it may begin one of the tokenizer's special strings
                rest.append(word)
            elif letters.isalpha():
                self.words[word] = self._run(letters.lower()) + self._run(signs)
            elif latin(wide := letters.decode("utf-8", "replace")):
                self.words[word] = self._run(wide.lower().encode()) + self._run(signs)
            else:
                rest.append(word)
        found = self.tokenizer.encode_batch([w.decode("utf-8", "replace") for w in rest], add_special_tokens=False)
        for word, encoded in zip(rest, found, strict=True):
            self.words[word] = packed_ids(encoded.ids)
        get = self.words.__getitem__
        for words in group:
            yield b"".join(map(get, words))

    def _run(self, run: bytes) -> bytes:
        ids = self.runs.get(run)
        if ids is None:
            # The tokenizer's vocabulary spells bytes as printable characters.
            spelled = run.decode("latin-1").translate(SPELLING)
            ids = self.runs[run] = packed_ids([t.id for t in self.model.tokenize(spelled)])
        return ids


def latin(word: str) -> bool:
    """Composed letters below U+0250 whose lower case is one letter too: the tokenizer only lowers them."""
    return word.isalpha() and max(word) < "\u0250" and "\u0130" not in word and is_normalized("NFC", word)


def packed_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=2)
def encoder_of(path: str) -> WordEncoder:
    """One encoder for each worker process, which keeps its words from task to task."""
    return WordEncoder(path)


class Packer:
    """Pieces of documents in sequences; a piece is (document row, first id, number of ids)."""

    def __init__(self, length: int = LENGTH):
        self.length = length
        #: Number of open sequences by fill level; level 0 and the full level stay 0.
        self.counts = np.zeros(length + 1, np.int64)
        self.open: dict[int, list[list[tuple]]] = defaultdict(list)
        self.opened = 0

    def place(self, piece: tuple) -> list[list[tuple]]:
        """Places a piece shorter than a sequence; sequences that are full or closed come back."""
        size = piece[2]
        # Moving a sequence from level h to h + size changes the sum by 2 * (counts[h + size] - counts[h]) + 2;
        # a new sequence changes it by 2 * counts[size] + 1, a filled one by 1 - 2 * counts[h].
        counts = self.counts
        below = counts[1 : self.length - size + 1]
        above = counts[size + 1 : self.length + 1]
        change = 2 * (above - below) + 2
        change[-1:] -= 1
        change[below == 0] = np.iinfo(np.int64).max
        best = len(change) - 1 - int(change[::-1].argmin()) if len(change) else -1
        if best < 0 or 2 * counts[size] + 1 < change[best]:
            level, sequence = 0, []
            self.opened += 1
        else:
            level = best + 1
            sequence = self.open[level].pop()
            counts[level] -= 1
        sequence.append(piece)
        level += size
        if level == self.length:
            self.opened -= 1
            return [sequence]
        counts[level] += 1
        self.open[level].append(sequence)
        return self.close() if self.opened >= MAX_OPEN else []

    def close(self) -> list[list[tuple]]:
        """Closes what is open: the emptiest sequences are cut to fill the fullest."""
        left = [s for level in sorted(self.open, reverse=True) for s in self.open[level]]
        self.open.clear()
        self.counts[:] = 0
        self.opened = 0
        done, first, last = [], 0, len(left) - 1
        while first < last:
            room = self.length - sum(p[2] for p in left[first])
            while room and first < last:
                row, start, size = left[last].pop()
                cut = min(room, size)
                left[first].append((row, start + size - cut, cut))
                if cut < size:
                    left[last].append((row, start, size - cut))
                room -= cut
                if not left[last]:
                    last -= 1
            if room == 0:
                done.append(left[first])
                first += 1
        if first <= last:
            done += self.powers(left[first])
        return done

    def powers(self, sequence: list[tuple]) -> list[list[tuple]]:
        """Cuts a sequence into sequences whose lengths are powers of two."""
        total = sum(p[2] for p in sequence)
        parts, todo = [], list(reversed(sequence))
        for power in (1 << b for b in reversed(range(total.bit_length()))):
            if not total & power:
                continue
            part, room = [], power
            while room:
                row, start, size = todo.pop()
                cut = min(room, size)
                part.append((row, start, cut))
                if cut < size:
                    todo.append((row, start + cut, size - cut))
                room -= cut
            parts.append(part)
        return parts


def pack(docs: DataFrame, tokenizer_path: str, length: int = LENGTH, id_col: str = "doc_id") -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset."""
    columns = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    kind = docs.schema[id_col].dataType.simpleString()
    end = np.asarray([END_ID], "<u4").tobytes()

    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = encoder_of(tokenizer_path), Packer(length)
        number = TaskContext.get().partitionId() * SEQUENCES_PER_TASK
        rows: list[tuple] = []
        held = 0

        def emit(sequences: list[list[tuple]]) -> None:
            nonlocal number, held
            for sequence in sequences:
                offset = 0
                for (doc_id, ids), start, size in sequence:
                    rows.append((doc_id, start, size, ids[4 * start : 4 * (start + size)], len(ids) // 4, number, offset))
                    offset += size
                held += offset
                number += 1

        def flushed() -> pa.RecordBatch:
            nonlocal held
            held = 0
            types = [id_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(v, t) for v, t in zip(zip(*rows, strict=True), types, strict=True)]
            rows.clear()
            return pa.RecordBatch.from_arrays(arrays, columns)

        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            texts = batch.column("text").to_pylist()
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(texts), strict=True):
                document = (doc_id, ids + end)
                total = len(ids) // 4 + 1
                whole = total - total % length
                emit([[(document, at, length)] for at in range(0, whole, length)])
                if whole < total:
                    emit(packer.place((document, whole, total - whole)))
                if held >= 1 << 20:
                    yield flushed()
        emit(packer.close())
        if rows:
            yield flushed()

    text = docs.select(F.col(id_col).alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = f"doc_id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
    return text.mapInArrow(packed, schema)
