"""Byte-level BPE: texts to token ids and back, as the ``tokenizers`` library does with the tokenizer's own file.

A text is cut at the strings of special tokens, what lies between into words by the byte-level pattern. A word starts
as one part for each byte. ``merged`` holds its parts contiguously, each at the boundary where it begins, and for each
two neighbours the rank of their merge; it scans for the least rank, the leftmost of equal ones, deletes the boundary
between the two and refreshes the ranks of the neighbours, until no neighbours merge. Scanning costs the square of the
word's length, so words of more than ``LONG_WORD`` bytes take the same merges in the same order from a heap.

Decoding joins the bytes of the tokens and reads them as UTF-8; what is no UTF-8 becomes U+FFFD. Ids that the
vocabulary does not have, and null ids, are skipped.

Each row is encoded on its own, nothing shuffles, and a task run again gives the same ids. Memory holds some texts at a
time, and at most ``MAX_WORDS`` words of at most ``LONG_WORD`` bytes with their ids. A null or empty text has no ids;
no ids give an empty text, and so do null ids in place of an array. Repeated rows are encoded one by one, null document
ids are carried, other columns are never read, an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.packing import SPELLING

MAX_WORDS = 400_000
#: Longer words, in bytes, are merged from a heap and not remembered.
LONG_WORD = 128
#: Ids that leave a task together.
GROUP_IDS = 1 << 18
NONE = 1 << 62
BYTES = {chr(SPELLING.get(b, b)): b for b in range(256)}


class Vocabulary:
    """Tokens, merges and special tokens of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        #: Rank of the merge of two ids, and the id that each merge makes.
        self.ranks = {ids[a] << 32 | ids[b]: rank for rank, (a, b) in enumerate(pairs)}
        self.made = [ids[a + b] for a, b in pairs]
        self.byte_ids = [ids[chr(SPELLING.get(b, b))] for b in range(256)]
        self.spelled = {i: spelled_bytes(token) for token, i in (ids | self.special).items()}

    def merged(self, word: bytes) -> list[int]:
        """Ids of a word."""
        parts = [self.byte_ids[b] for b in word]
        if len(parts) > LONG_WORD:
            return self._merged_from_heap(parts)
        rank_of = self.ranks.get
        ranks = [rank_of(a << 32 | b, NONE) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks:
            least = min(ranks)
            if least == NONE:
                break
            at = ranks.index(least)
            parts[at] = self.made[least]
            del parts[at + 1], ranks[at]
            if at < len(ranks):
                ranks[at] = rank_of(parts[at] << 32 | parts[at + 1], NONE)
            if at:
                ranks[at - 1] = rank_of(parts[at - 1] << 32 | parts[at], NONE)
        return parts

    def _merged_from_heap(self, parts: list[int]) -> list[int]:
        size = len(parts)
        before, after = list(range(-1, size - 1)), list(range(1, size + 1))
        heap: list[tuple[int, int, int]] = []

        def offer(at: int) -> None:
            if at >= 0 and after[at] < size:
                pair = parts[at] << 32 | parts[after[at]]
                if (rank := self.ranks.get(pair)) is not None:
                    heapq.heappush(heap, (rank, at, pair))

        for at in range(size):
            offer(at)
        while heap:
            rank, at, pair = heapq.heappop(heap)
            # Offers outlive the parts they were made for.
            if parts[at] < 0 or after[at] == size or parts[at] << 32 | parts[after[at]] != pair:
                continue
            gone = after[at]
            parts[at], parts[gone] = self.made[rank], -1
            after[at] = after[gone]
            if after[gone] < size:
                before[after[gone]] = at
            offer(at)
            offer(before[at])
        return [p for p in parts if p >= 0]

    def decoded(self, ids: list[int]) -> str:
        spelled = self.spelled
        return b"".join([spelled[i] for i in ids if i in spelled]).decode("utf-8", "replace")


def spelled_bytes(token: str) -> bytes:
    """Bytes that a token stands for; a token with other characters stands for its own UTF-8."""
    if all(c in BYTES for c in token):
        return bytes(BYTES[c] for c in token)
    return token.encode()


#: White space as the pattern knows it.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def taken_for(kind: str, last: int) -> str:
    """Code points up to ``last`` that the library takes for letters (kind L) or numbers (N), as ranges of a class.

    Its Unicode version knows fewer of them than the ``regex`` module. One pass over all the module knows, each between
    two signs, tells which: a letter or number is a word of its own there, a sign joins the signs around it.
    """
    import regex
    from tokenizers import pre_tokenizers

    every = "".join(chr(c) for c in range(last + 1) if not 0xD800 <= c < 0xE000)
    known = regex.findall(rf"\p{{{kind}}}", every)
    library = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    runs: list[list[int]] = []
    for at in range(0, len(known), 1000):
        found = library.pre_tokenize_str("!" + "!".join(known[at : at + 1000]) + "!")
        for code in (ord(known[at + a // 2]) for _, (a, b) in found if a % 2 and b - a == 1):
            if runs and code == runs[-1][1] + 1:
                runs[-1][1] = code
            else:
                runs.append([code, code])
    return "".join(rf"\U{a:08X}-\U{b:08X}" for a, b in runs)


def word_pattern(last: int) -> re.Pattern[str]:
    """The byte-level pattern for texts without code points above ``last``."""
    letter, number = taken_for("L", last), taken_for("N", last)
    return re.compile(
        rf"'(?:[stmd]|re|ve|ll)| ?[{letter}]+| ?[{number}]+| ?[^{SPACE}{letter}{number}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
    )


class Encoder:
    """Ids of texts, with the words met so far."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        #: Most texts have no code points above U+FFFF; their classes are the faster ones.
        self.pattern, self.wide, self.wide_pattern = word_pattern(0xFFFF), re.compile("[\U00010000-\U0010ffff]"), None
        special = sorted(self.vocabulary.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.words: dict[str, bytes] = {}

    def encode(self, text: str | None) -> bytes:
        """Ids of a text, as little-endian 32-bit numbers."""
        if not text:
            return b""
        if self.cut is None or not self.cut.search(text):
            return self._plain(text)
        special = self.vocabulary.special
        parts = self.cut.split(text)
        return b"".join(struct.pack("<i", special[p]) if k % 2 else self._plain(p) for k, p in enumerate(parts))

    def _plain(self, text: str) -> bytes:
        if self.wide.search(text):
            self.wide_pattern = self.wide_pattern or word_pattern(0x10FFFF)
            words = self.wide_pattern.findall(text)
        else:
            words = self.pattern.findall(text)
        known = self.words
        rare: dict[str, bytes] = {}
        for word in [w for w in set(words) if w not in known]:
            spelled = word.encode()
            ids = self.vocabulary.merged(spelled)
            (known if len(spelled) <= LONG_WORD else rare)[word] = struct.pack(f"<{len(ids)}i", *ids)
        found = b"".join([known.get(w) or rare[w] for w in words] if rare else map(known.__getitem__, words))
        if len(known) > MAX_WORDS:
            known.clear()
        return found


@lru_cache(maxsize=2)
def encoder_of(path: str) -> Encoder:
    """One encoder for each worker process, which keeps its words from task to task."""
    return Encoder(path)


@lru_cache(maxsize=2)
def vocabulary_of(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids of every row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer_path)

        def group(rows: pa.RecordBatch, first: int, found: list[bytes]) -> pa.RecordBatch:
            ends = np.cumsum([0, *map(len, found)]) // 4
            ids = pa.array(np.frombuffer(b"".join(found), "<i4"), pa.int32())
            arrays = [
                rows.column("doc_id").slice(first, len(found)),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids),
            ]
            return pa.RecordBatch.from_arrays(arrays, ["doc_id", "ids"])

        for batch in batches:
            first, found, held = 0, [], 0
            for n, text in enumerate(batch.column("text").to_pylist()):
                found.append(encoder.encode(text))
                held += len(found[-1]) // 4
                if held >= GROUP_IDS:
                    yield group(batch, first, found)
                    first, found, held = n + 1, [], 0
            if found:
                yield group(batch, first, found)

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(encoded, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, ids and the text they stand for."""
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(tokenizer_path)
        for batch in batches:
            lists = batch.column("ids")
            ends = np.cumsum([0, *lists.value_lengths().fill_null(0).to_pylist()])
            # A null id becomes one that no token has. Ids become Python numbers text by text.
            ids = lists.flatten().fill_null(-1).to_numpy()
            texts = [vocabulary.decoded(ids[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            arrays = [batch.column("doc_id"), lists, pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "ids", "text"])

    rows = encoded.select("doc_id", F.col("ids").cast("array<int>").alias("ids"))
    return rows.mapInArrow(decoded, f"doc_id {kind}, ids array<int>, text string")
