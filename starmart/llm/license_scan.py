"""Licence scan: passages compared with licence templates by the Dice coefficient over word bigrams.

Text and templates are normalised alike: A-Z lowered, words are runs of ASCII letters and digits, with version numbers
such as 2.0 kept whole. Passages are the whole text, its blocks (between blank lines), its lines and its sentences, and
runs of neighbouring sentences, over the ends of lines and blocks, that begin and end with one that shares a bigram with
the template: leaving out one at the end that shares none cannot lower the coefficient. A passage
whose distinct bigrams A and a template's bigrams B reach 2 |A & B| / (|A| + |B|) >= least_dice matches the template.

Since |A & B| <= min(|A|, |B|), only templates with least / (2 - least) * |A| <= |B| <= (2 - least) / least * |A| can
match; a table from bigram to templates then leaves those that share a bigram at all. Templates are a list that the
caller passes; they travel with the function.

A run counts only if it matches better than every other passage it overlaps, and at least as well as the runs of other
licences it overlaps; a passage inside a run that matches another licence better does not count.

A null or empty text, or one with fewer than two words in every passage, has no match. A passage counts
for the template it matches best; of several passages for a licence the best is reported, then the first, then the
longest. Repeated rows are scanned one by one; other columns
are never read; an empty table gives an empty result. Nothing shuffles.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.license_texts import TEMPLATES

LEAST_DICE = 0.85
WORD = re.compile(rb"[a-z0-9]+(?:\.[0-9]+)*")
BLOCK = re.compile(r"\n[ \t\r]*\n\s*")
SENTENCE = re.compile(r"(?<=[.!?])\s+")

Gram = tuple[bytes, bytes]


def bigrams(text: str) -> set[Gram]:
    words = WORD.findall(text.encode("utf-8", "surrogatepass").lower())
    return set(zip(words, words[1:], strict=False))


class Scanner:
    def __init__(self, templates: list[tuple[str, str]], least_dice: float = LEAST_DICE):
        self.least = least_dice
        self.names = [name for name, _ in templates]
        self.grams = grams = [bigrams(text) for _, text in templates]
        self.sizes = [len(g) for g in grams]
        holders: dict[Gram, list[int]] = defaultdict(list)
        for t, own in enumerate(grams):
            for gram in own:
                holders[gram].append(t)
        self.holders = dict(holders)
        sizes = [s for s in self.sizes if s]
        self.ratio = least_dice / (2 - least_dice)
        self.smallest = min(sizes, default=0) * self.ratio
        self.largest = max(sizes, default=-1) / self.ratio

    def shared(self, own: set[Gram]) -> Counter:
        """Bigrams that a set shares with each template."""
        return Counter(t for gram in own & self.holders.keys() for t in self.holders[gram])

    def best(self, text: str) -> tuple[float, int] | None:
        """(dice, template) of the template that a passage matches best; of equal ones the first."""
        # A passage with n bigrams has at least n + 1 words of one character.
        if len(text) < 2 * self.smallest:
            return None
        own = bigrams(text)
        size = len(own)
        if not self.smallest <= size <= self.largest:
            return None
        best = None
        for t, common in self.shared(own).items():
            bound = self.least * (size + self.sizes[t])
            if 2 * min(size, self.sizes[t]) >= bound and 2 * common >= bound:
                found = 2 * common / (size + self.sizes[t])
                if best is None or (-found, t) < (-best[0], best[1]):
                    best = found, t
        return best

    def scan(self, text: str | None) -> list[dict]:
        """The best match of each licence: license, dice, start, end (code points), by license."""
        # No passage shares more with a template than the text does, and a match shares least / (2 - least) of it.
        if not text:
            return []
        near = [t for t, n in self.shared(bigrams(text)).items() if n >= self.ratio * self.sizes[t]]
        if not near:
            return []
        single = []
        for start, end in passages(text):
            if match := self.best(text[start:end]):
                single.append((-match[0], start, -end, self.names[match[1]]))
        runs: list[tuple] = []
        for run in sorted(self.runs(text, near, single)):
            if not any(r[0] < run[0] and r[3] != run[3] and overlap(r, run) for r in runs):
                runs.append(run)
        single = [m for m in single if not any(r[0] < m[0] and r[3] != m[3] and inside(m, r) for r in runs)]
        found: dict[str, tuple] = {}
        for *rank, name in sorted(single + runs):
            found.setdefault(name, tuple(rank))
        return [
            {"license": name, "dice": -dice, "start": start, "end": -end}
            for name, (dice, start, end) in sorted(found.items())
        ]

    def runs(self, text: str, near: list[int], single: list[tuple]) -> Iterator[tuple[float, int, int, str]]:
        """(-dice, start, -end, licence) of the best run of two sentences or more from each first one, by template."""
        units, own, links, last = [], [], [], None
        for start, end in sentences(text):
            words = WORD.findall(text[start:end].encode("utf-8", "surrogatepass").lower())
            if words:
                units.append((start, end))
                own.append(list(zip(words, words[1:], strict=False)))
                links.append((last, words[0]))
                last = words[-1]
        # The best match of another passage over each sentence; passages are nested at most four deep.
        reached, starts = [0.0] * len(units), [start for start, _ in units]
        for dice, start, end, _ in single:
            for u in range(bisect_left(starts, start), bisect_left(starts, -end)):
                reached[u] = max(reached[u], -dice)
        for t in near:
            wanted, most = self.grams[t], self.sizes[t] / self.ratio
            shares = [not wanted.isdisjoint(grams) for grams in own]
            linked = [link in wanted for link in links] + [False]
            for i in range(len(units) - 1):
                if not (shares[i] or linked[i + 1]):
                    continue
                held, best, least = set(own[i]), None, reached[i]
                common = len(held & wanted)
                for j in range(i + 1, len(units)):
                    for gram in (links[j], *own[j]):
                        if gram not in held:
                            held.add(gram)
                            common += gram in wanted
                    if len(held) > most:
                        break
                    least = max(least, reached[j])
                    if least == 1:
                        break
                    size = len(held) + self.sizes[t]
                    if 2 * common >= self.least * size and 2 * common > least * size and (shares[j] or linked[j]):
                        rank = -2 * common / size, units[i][0], -units[j][1], self.names[t]
                        best = min(best or rank, rank)
                if best:
                    yield best


def overlap(a: tuple, b: tuple) -> bool:
    """Whether passages (-dice, start, -end, licence) share a place."""
    return a[1] < -b[2] and b[1] < -a[2]


def inside(a: tuple, b: tuple) -> bool:
    return b[1] <= a[1] and -a[2] <= -b[2]


def sentences(text: str) -> Iterator[tuple[int, int]]:
    for block in cut(BLOCK, text, 0, len(text)):
        for line in cut(NEWLINE, text, *block):
            yield from cut(SENTENCE, text, *line)


def passages(text: str) -> Iterator[tuple[int, int]]:
    """Places of the whole text, its blocks, lines and sentences; none twice in a row."""
    seen = (0, len(text))
    if text:
        yield seen
    for b0, b1 in cut(BLOCK, text, 0, len(text)):
        if (b0, b1) != seen:
            yield (b0, b1)
        for l0, l1 in cut(NEWLINE, text, b0, b1):
            if (l0, l1) != (b0, b1):
                yield (l0, l1)
            for s in cut(SENTENCE, text, l0, l1):
                if s != (l0, l1):
                    yield s


NEWLINE = re.compile(r"\n")


def cut(pattern: re.Pattern, text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    at = start
    for gap in pattern.finditer(text, start, end):
        if gap.start() > at:
            yield at, gap.start()
        at = gap.end()
    if end > at:
        yield at, end


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, least_dice: float = LEAST_DICE) -> DataFrame:
    """doc_id, matches [(license, dice, start, end)] of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    match = pa.list_(
        pa.struct([("license", pa.string()), ("dice", pa.float64()), ("start", pa.int64()), ("end", pa.int64())])
    )

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, least_dice)
        for batch in batches:
            found = pa.array(map(scanner.scan, batch.column("text").to_pylist()), match)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), found], ["doc_id", "matches"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    fields = "array<struct<license: string, dice: double, start: bigint, end: bigint>>"
    return rows.mapInArrow(scanned, f"doc_id {kind}, matches {fields}")
