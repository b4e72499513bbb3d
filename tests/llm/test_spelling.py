"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from starmart.llm import queries, spelling

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def brute_variants(counts):
    close = {w: [] for w in counts}
    for a in counts:
        for b in counts:
            if a < b and abs(len(a) - len(b)) < 2 and one_edit(a, b):
                close[a].append(b)
                close[b].append(a)
    form = {}
    for w, others in close.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best and counts[best] >= 5 * counts[w] else None
    rows = {}
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        rows[w] = (form[w], root, n, len(close[w]), counts[form[w]] if form[w] else None)
    return rows


def brute_counts(docs):
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % 199 == 0:
                k = h % len(word)
                word = word[:k] + word[k + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def found_rows(df):
    rows = df.collect()
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: tuple(r)[1:] for r in rows}


@pytest.mark.parametrize(("letters", "seed"), [("ab", 1), ("abcé", 2), ("abcdefghijklmnopqrstuvwxyzÀ", 3)])
def test_variants(spark, letters, seed):
    r = random.Random(seed)
    words = set()
    while len(words) < 700:
        word = "".join(r.choice(letters) for _ in range(r.randrange(6, 12)))
        for _ in range(6):
            words.add(word)
            at = r.randrange(len(word))
            word = r.choice([word[:at] + word[at + 1 :], word[:at] + r.choice(letters) + word[at:], word[:at] + r.choice(letters) + word[at + 1 :]])
            if len(word) < 6:
                break
    counts = {w: 5 * r.choice([1, 1, 2, 5, 30, 150, 900]) for w in words}
    found = spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n bigint"))
    assert found_rows(found) == brute_variants(counts)


def test_every_near_pair_shares_an_entry():
    r = random.Random(7)
    for letters in ("ab", "abcdef"):
        words = sorted({"".join(r.choice(letters) for _ in range(r.randrange(4, 9))) for _ in range(500)})
        counts = Counter(w[i : i + 2] for w in words for i in range(len(w) - 1))
        order = {g: (k, n) for k, (n, g) in enumerate(sorted((n, g) for g, n in counts.items()))}
        places = {w: spelling.prefix(w, order) for w in words}
        index = {w: set(spelling.prefix_keys(w, places[w][0])) for w in words}
        seen = 0
        for a in words:
            left, right = spelling.pivots(a, places[a][0], order)
            assert left + 2 <= right and {left, right} <= set(places[a][0])
            probes = set(spelling.pivot_keys(a, left, right))
            for b in words:
                if abs(len(a) - len(b)) < 2 and places[a][1] <= places[b][1] and one_edit(a, b):
                    seen += 1
                    assert probes & index[b], (a, b)
        assert seen > 100


def test_odd_rows(spark, docs, nothing):
    rows = [(None, "Straße STRAßE straße Straße straße strase"), (1, "ÀÉÎÕÜ× ÀÉÎÕÜ× ÀÉÎÕÜ× ÀÉÎÕÜ× ÀÉÎÕÜ× àéîõü÷"), (2, None), (3, ""), (4, "x1y2 -- 123456")]
    rows += [(5, "letters " * 400), (6, "lettres letter’s Letters " * 9), (7, "z" * 30_000)] * 2
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("other") for c in ("word", "n", "key", "other")})
    expected = brute_variants(brute_counts(rows))
    assert found_rows(spelling.group(table, spelling.misspelled)) == expected and len(expected) > 3
    assert spelling.group(nothing).collect() == []
    assert found_rows(spelling.group(docs, spelling.misspelled)).keys() == brute_counts([(r.doc_id, r.text) for r in docs.collect()]).keys()
    with pytest.raises(ValueError):
        spelling.counted(table, least_length=3)


def test_chains_of_forms(spark):
    chain = ["aaaaaa", "aaaaab", "aaaabb", "aaabbb", "aabbbb", "abbbbb", "bbbbbb"]
    counts = {w: 5 * 6**k for k, w in enumerate(chain)}
    found = found_rows(spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n bigint")))
    assert {r[1] for r in found.values()} == {"bbbbbb"} and found == brute_variants(counts)


def test_only_counted_sides_are_broadcast(spark, tmp_path, monkeypatch):
    """Spark takes entries to be as large as the compressed words they are made of."""
    r = random.Random(4)
    counts = {"".join(r.choice("abcde") for _ in range(r.randrange(6, 9))): r.choice([5, 30, 900]) for _ in range(3000)}
    spark.createDataFrame(list(counts.items()), "word string, n bigint").write.parquet(str(tmp_path / "words"))
    words = spark.read.parquet(str(tmp_path / "words"))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan(spelling.near(words)) and "SortMergeJoin" in plan(spelling.near(words))
    assert "BroadcastExchange" in plan(words.join(spelling.few_or_sorted(words), "word"))
    monkeypatch.setattr(spelling, "FEW_LINKS", 10)
    found = spelling.variants(words)
    assert "BroadcastExchange" not in plan(found) and found_rows(found) == brute_variants(counts)


def test_query_and_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    found = found_rows(queries.op11_spelling(spark, folder))
    docs = [(r.doc_id, r.text) for r in queries.table(spark, folder, "documents").collect()]
    counts = brute_counts(docs)
    assert {w: r[2] for w, r in found.items()} == counts
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW documents AS FROM '{folder}/documents.parquet'")
        assert found == {r[0]: r[1:] for r in con.sql(queries.ORACLES["op11_spelling"]).fetchall()}
