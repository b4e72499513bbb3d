"""N-gram join, line dedup and components against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from starmart.llm import components, line_dedup, ngram_join

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


class Union:
    def __init__(self, nodes):
        self.parent = {n: n for n in nodes}

    def find(self, x):
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def link(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def shingles(text, words):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(found) < words:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + words]) for i in range(len(found) - words + 1)}


def brute_components(docs, words, percent):
    sets = {d: shingles(t, words) for d, t in docs}
    groups = Union(sets)
    holders = defaultdict(list)
    for d, own in sets.items():
        met = Counter(e for g in own for e in holders[g])
        for e, n in met.items():
            if 100 * n >= percent * (len(own) + len(sets[e]) - n):
                groups.link(d, e)
        for g in own:
            holders[g].append(d)
    return {d: (len(own), groups.find(d)) for d, own in sets.items()}


def near_copies(seed, groups, copies, length, changes):
    r = random.Random(seed)
    docs = []
    for g in range(groups):
        base = [f"w{g}x{r.randrange(length)}" for _ in range(length)]
        for _ in range(copies):
            text = list(base)
            for _ in range(r.randrange(changes)):
                text[r.randrange(length)] = f"n{r.randrange(10**6)}"
            docs.append((len(docs), " ".join(text)))
    return docs


@pytest.mark.parametrize(("words", "percent"), [(3, 90), (5, 80)])
@pytest.mark.parametrize("many", [64, 4])
def test_join_finds_the_components(spark, monkeypatch, words, percent, many):
    monkeypatch.setattr(ngram_join, "MANY", many)
    docs = near_copies(5, 3, 60, 90, 6) + [(1000, "one"), (1001, "One"), (1002, None), (1003, "")]
    found = ngram_join.join(spark.createDataFrame(docs, "doc_id long, text string"), ngram_join.Rule(words, percent))
    rows = {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()}
    assert rows == brute_components(docs, words, percent)


@pytest.mark.parametrize("percent", [80, 85, 90])
def test_linking_sets_share_an_entry(percent):
    rule, r, seen = ngram_join.Rule(3, percent), np.random.default_rng(percent), 0
    for _ in range(6000):
        one = r.integers(0, 1 << 63, int(r.integers(2, 60)), dtype=np.uint64)
        two = list(one)
        for _ in range(int(r.integers(0, 7))):
            if r.random() < 0.5 and len(two) > 1:
                two.pop(int(r.integers(len(two))))
            else:
                two.append(r.integers(0, 1 << 63, dtype=np.uint64))
        one, two = np.unique(one), np.unique(np.array(two, np.uint64))
        common = len(np.intersect1d(one, two))
        union = len(one) + len(two) - common
        if common == union or 100 * common < percent * union:
            continue
        seen += 1
        keys = [
            {int(k) for h in rule.bands(len(s)) if rule.segments(h) > 1 for k in ngram_join.set_keys(s, h, rule)}
            for s in (one, two)
        ]
        assert keys[0] & keys[1]
        flips = ngram_join.parities(one) ^ ngram_join.parities(two)
        assert sum(int(f).bit_count() for f in flips.view(np.uint64)) <= union - common
    assert seen > 1000


@pytest.mark.parametrize("percent", [80, 90])
def test_sets_that_just_link_share_an_entry(percent):
    # As different as their sizes allow, so nothing is in reserve; and no set holds more entries than it must.
    rule, r, left_out = ngram_join.Rule(5, percent), np.random.default_rng(percent), 0
    for _ in range(3000):
        one = np.unique(r.integers(0, 1 << 63, int(r.integers(4, 400)), dtype=np.uint64))
        gone = int(r.integers(0, len(one) * (100 - percent) // 100 + 1))
        kept = r.permutation(one)[gone:]
        # Of (kept + new) shingles the other set has, kept are common: 100 * kept >= percent * (one + new).
        new = max(0, 100 * len(kept) // percent - len(one))
        two = np.unique(np.concatenate([kept, r.integers(0, 1 << 63, new, dtype=np.uint64)]))
        assert 100 * len(kept) >= percent * (len(one) + len(two) - len(kept))
        keys = []
        for s in (one, two):
            found = set()
            for high in rule.bands(len(s)):
                entries = ngram_join.set_keys(s, high, rule)
                left_out += len(entries) < rule.segments(high)
                found.update(entries.tolist())
            keys.append(found)
        assert keys[0] & keys[1]
    assert left_out > 6000


def test_allocation_covers_all_segments():
    r = random.Random(2)
    for _ in range(500):
        costs = [(s, e := r.choice([0, 1, 50]), e + r.choice([0, 2, 70])) for s in range(r.randrange(1, 12))]
        spare = r.randrange(len(costs))
        found = ngram_join.allocated(costs, spare)
        assert sum(v + 1 for _, v in found) == len(costs) - spare
        assert len(found) <= len(costs) - spare and len({s for s, _ in found}) == len(found)


def test_sets_just_below_the_similarity_make_few_candidates(spark, monkeypatch):
    """120 texts that differ in 6 words each from a common one: 7,140 pairs at a similarity of about 0.73."""
    monkeypatch.setattr(ngram_join, "MANY", 4)
    r, docs = random.Random(8), []
    base = [f"w{i}" for i in range(385)]
    for d in range(120):
        text = list(base)
        for at in r.sample(range(385), 6):
            text[at] = f"n{r.randrange(10**9)}"
        docs.append((d, " ".join(text)))
    # A chain of links: three words more than in the text before.
    docs += [(200 + i, f"{docs[7][1]} " + " ".join(f"m{j}" for j in range(3 * i))) for i in range(1, 8)]
    made, whole = [], ngram_join.probed
    monkeypatch.setattr(ngram_join, "probed", lambda *a: made.append(whole(*a)) or made[-1])
    found = ngram_join.join(spark.createDataFrame(docs, "doc_id long, text string"), ngram_join.Rule(5, 80))
    rows = {x.doc_id: (x.n_shingles, x.component_id) for x in found.collect()}
    assert rows == brute_components(docs, 5, 80)
    assert len(made) == 1 and made[0].count() <= 400


def test_fine_parities_never_exceed_the_difference():
    r = np.random.default_rng(9)
    for _ in range(300):
        one = np.unique(r.integers(0, 1 << 63, int(r.integers(1, 900)), dtype=np.uint64)) << np.uint64(1)
        two = np.union1d(one[r.random(len(one)) < 0.9], r.integers(0, 1 << 63, len(one) // 8, dtype=np.uint64))
        odd = ngram_join.parities(one, ngram_join.FINE) ^ ngram_join.parities(two, ngram_join.FINE)
        assert len(odd) == len(ngram_join.FINE)
        flips = sum(int(f).bit_count() for f in odd.view(np.uint64))
        differ = len(np.setxor1d(one, two))
        assert flips <= differ and (differ - flips) % 2 == 0


def test_join_of_odd_rows(docs, nothing):
    rows = ngram_join.join(docs, ngram_join.Rule(3, 90)).collect()
    assert len(rows) == docs.count()
    by = defaultdict(set)
    for r in rows:
        by[r.doc_id].add((r.n_shingles, r.component_id))
    assert by[1] == by[2] == by[3] == {(8, 1)}
    assert by[4] == {(0, 4)} and by[5] == {(0, 5)} and by[6] == {(0, 6)}
    assert by[8] == {(1, 8)} and by[9] == {(1, 9)}
    kept = ngram_join.dedup(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [1, 4, 5, 6, 7, 8, 9]
    assert ngram_join.join(nothing).collect() == [] and ngram_join.dedup(nothing).collect() == []


def test_components_of_long_paths(spark):
    r = random.Random(4)
    edges = [(i, i + 1) for i in range(200) if i % 50] + [(r.randrange(300, 400), r.randrange(300, 400)) for _ in range(80)]
    groups = Union({n for e in edges for n in e})
    for a, b in edges:
        groups.link(a, b)
    found = components.components(spark.createDataFrame([*edges, (7, 7), (None, 3)], "a long, b long")).collect()
    assert {x.node: x.component for x in found} == {n: groups.find(n) for e in edges if e[0] != e[1] for n in e}


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(r, text, edits, letters):
    text = list(text)
    for _ in range(edits):
        at = r.randrange(len(text) + 1)
        kind = r.randrange(3)
        if kind == 0:
            text.insert(at, r.choice(letters))
        elif at < len(text):
            text[at : at + 1] = [] if kind == 1 else [r.choice(letters)]
    return "".join(text)


def test_within():
    r = random.Random(1)
    for _ in range(5000):
        a = "".join(r.choice("ab") for _ in range(r.randrange(9)))
        b = edited(r, a, r.randrange(4), "ab") if r.random() < 0.7 else "".join(r.choice("ab") for _ in range(r.randrange(9)))
        for edits in range(4):
            assert line_dedup.within(a, b, edits) == (edit_distance(a, b) <= edits)


def test_lines_within_reach_share_a_place():
    r = random.Random(3)
    for _ in range(3000):
        a = "".join(r.choice("abcd") for _ in range(r.randrange(3, 30)))
        b = edited(r, a, r.randrange(3), "abcd")
        a, b = sorted((a, b), key=len)
        if edit_distance(a, b) > 2 or len(a) < 3:
            continue
        own = {(n, i, a[p : p + s]) for role, n, i, p, s in line_dedup.places(len(a), 2) if role == line_dedup.INDEXED}
        assert own & {(n, i, b[p : p + s]) for _, n, i, p, s in line_dedup.places(len(b), 2)}


def brute_lines(docs, edits, least):
    lines = [
        (d, i, x.strip(" \t\r\x0b\x0c"))
        for d, t in sorted(docs, key=lambda x: (x[0] is None, x[0]))
        for i, x in enumerate((t or "").split("\n"))
    ]
    lines = [x for x in lines if x[2]]
    known = sorted({x[2] for x in lines}, key=len)
    groups = Union(known)
    for i, a in enumerate(known):
        for b in known[i + 1 :]:
            if len(b) - len(a) > edits:
                break
            if len(a) >= least and edit_distance(a, b) <= edits:
                groups.link(a, b)
    seen, lost = set(), Counter()
    for d, _, line in lines:
        lost[d] += groups.find(line) in seen
        seen.add(groups.find(line))
    return {d: n for d, n in lost.items() if n}


@pytest.mark.parametrize("many", [16, 3])
def test_line_dedup(spark, monkeypatch, many):
    monkeypatch.setattr(line_dedup, "MANY", many)
    r = random.Random(6)
    base = "".join(r.choice("abcdefgh ") for _ in range(30)) + "x"
    docs = [(d, "\n".join(edited(r, base, r.randrange(5), "abcdefghijk") + "  " for _ in range(2))) for d in range(40)]
    docs += [(100, None), (101, ""), (102, "\n \n"), (103, "short\nshort\nshorts")]
    rows = line_dedup.dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {x.doc_id: x.n_dropped for x in rows if x.n_dropped} == brute_lines(docs, 2, 20)
    assert {x.doc_id: x.text for x in rows}[103] == "short\nshorts"


def test_links_in_hot_entries(spark):
    """Equal lengths, an insertion and a deletion: the entry of the common tail is split, and no link is lost."""
    r = random.Random(11)
    tail = "0123456789 tail 01"
    lines = [a + tail for a in ("abcdefghi", "bcdefghij", "cdefghijk", "zabcdefgh")]
    lines += ["".join(r.choice("klmnopqrst") for _ in range(9)) + tail for _ in range(30)]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    ids = {x.id: x.line for x in line_dedup.lines_of(docs).select(line_dedup.line_id().alias("id"), "line").collect()}
    got = {frozenset((ids[x.a], ids[x.b])) for x in line_dedup.links(spark, docs, 2, 20).collect()}
    want = {frozenset((a, b)) for a in lines for b in lines if a < b and edit_distance(a, b) <= 2}
    assert frozenset(lines[:2]) in want and got == want


@pytest.mark.parametrize("many", [256, 16])
def test_near_copies_of_a_line_make_few_candidates(spark, monkeypatch, many):
    """300 copies of a line, each with another word in place of one: 44,850 pairs share an entry, few can link."""
    monkeypatch.setattr(line_dedup, "MANY", many)
    r = random.Random(21)
    word = lambda: "".join(r.choice("abcdefghijklmnopqrst") for _ in range(8))
    base = [word() for _ in range(20)]
    lines = []
    for _ in range(300):
        at = r.randrange(20)
        lines.append(" ".join([*base[:at], word(), *base[at + 1 :]]))
    lines += [edited(r, x, 1 + i % 2, "uvwxyz") for i, x in enumerate(lines[:30])]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    ids = {x.id: x.line for x in line_dedup.lines_of(docs).select(line_dedup.line_id().alias("id"), "line").collect()}
    got = {frozenset((ids[x.a], ids[x.b])) for x in line_dedup.links(spark, docs, 2, 20).collect()}
    known = sorted(set(lines))
    want = {frozenset((a, b)) for i, a in enumerate(known) for b in known[i + 1 :] if line_dedup.within(a, b, 2)}
    assert len(want) >= 30 and got == want
    pairs, _ = line_dedup.candidates(spark, docs, 2, 20)
    assert pairs.count() <= 2 * len(want) + 30
    assert max(len(line_dedup.places_of(n, 2)) for n in range(20, 2000)) <= 10


def test_line_dedup_of_odd_rows(docs, nothing):
    rows = line_dedup.dedup(docs).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == docs.count()
    # One class of lines; the first, and in equal rows the same line, stay.
    assert (by[1].n_dropped, by[2].n_dropped, by[3].n_dropped) == (0, 0 if by[2].text else 1, 1)
    assert by[4].text is None and by[4].n_lines == 0 and by[6].n_lines == 0
    assert line_dedup.dedup(nothing).collect() == []


def test_wide_parities_never_exceed_the_difference():
    r = np.random.default_rng(5)
    for _ in range(200):
        n = int(r.integers(1, 3000))
        one = np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64))
        two = np.union1d(one[r.random(len(one)) < 0.9], r.integers(0, 1 << 63, n // 8, dtype=np.uint64))
        differ = len(np.setxor1d(one, two))
        found = ngram_join.flips(ngram_join.wide_parities(one), ngram_join.wide_parities(two))
        assert found <= differ and (differ - found) % 2 == 0
        assert found > differ / 3


def test_a_packed_text_keeps_its_set():
    text = "Ünï cöde, and some more words; " * 40
    assert (ngram_join.unpacked(ngram_join.packed(text), ngram_join.Rule(5, 80)) == ngram_join.shingle_set(text, 5)).all()
