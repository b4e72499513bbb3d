"""The corpus pipeline against a plain version of its stages."""

import re
import zlib
from collections import defaultdict

import corpus_pipeline
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_pairs import brute_components
from test_texts import brute_contamination
from tokenizers import Tokenizer

from starmart.llm import common, queries, toxicity

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The small tables with nulls, copies, near copies and a benchmark passage added; ids stay unique."""
    path = str(tmp_path_factory.mktemp("corpus"))
    docs = queries.table(spark, SMALL, "documents")
    passage = queries.table(spark, SMALL, "benchmark").where(F.length("text") > 100).first().text
    base = " ".join(f"plain{i % 61} word{i}" for i in range(60))
    odd = [None, "", " \t\n", base, base.replace(" ", "\n "), base + " more", base.replace("word30", "other"), passage, f"before {passage} after"]
    rows = [(900_000 + i, text) for i, text in enumerate(odd)]
    more = spark.createDataFrame(rows, "doc_id long, text string")
    docs.unionByName(more, allowMissingColumns=True).write.parquet(f"{path}/documents.parquet")
    for name in ("labels", "benchmark"):
        queries.table(spark, SMALL, name).write.parquet(f"{path}/{name}.parquet")
    return path


def rows_of(df):
    return {r.doc_id: tuple(r) for r in df.collect()}


def test_every_stage(spark, folder):
    docs = queries.table(spark, folder, "documents")
    labels, items = queries.table(spark, folder, "labels"), queries.table(spark, folder, "benchmark")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact_dedup", "ngram_join", "decontamination", "packing"]
    at = docs.columns.index("text")

    before = rows_of(docs)
    after = rows_of(stages["toxicity"](spark, docs, folder))
    toxic = {r.doc_id for r in toxicity.toxicity(docs, labels).where("predicted = 1").collect()}
    assert after == {d: r for d, r in before.items() if d not in toxic}

    def run(name, rows):
        table = spark.createDataFrame(list(rows.values()), docs.schema)
        return stages[name](spark, table, folder)

    groups = defaultdict(list)
    for d, r in after.items():
        groups[re.sub(r"[\x20\x09-\x0D]", "", r[at] or "")].append((-len(r[at] or ""), d))
    before, after = after, rows_of(run("exact_dedup", after))
    kept = {min(g)[1] for g in groups.values()}
    assert after == {d: before[d] for d in kept} and len(kept) < len(before)

    found = brute_components([(d, r[at]) for d, r in after.items()], 5, 80)
    before, after = after, rows_of(run("ngram_join", after))
    assert after == {d: r for d, r in before.items() if found[d][1] == d} and len(after) < len(before)

    hits = brute_contamination([(d, r[at]) for d, r in after.items()], [(r.item_id, r.text) for r in items.collect()], 13)
    dirty = {h[0] for h in hits if h[-1]}
    before, after = after, rows_of(run("decontamination", after))
    assert after == {d: r for d, r in before.items() if d not in dirty} and dirty
    assert not {900_007, 900_008} & after.keys()  # the passage, alone and within a text

    check_pieces(run("packing", after).collect(), after, at)


def check_pieces(pieces, rows, at):
    tokenizer = Tokenizer.from_file(queries.vocabulary("word_bpe_49k.json"))
    spans, filled = defaultdict(list), defaultdict(list)
    for p in pieces:
        spans[p.doc_id].append(p)
        filled[p.sequence_id].append((p.offset, p.length))
    assert spans.keys() == rows.keys()
    for d, own in spans.items():
        ids = [*tokenizer.encode(rows[d][at] or "", add_special_tokens=False).ids, 1]
        next_id = 0
        for p in sorted(own, key=lambda p: p.start):
            data = b"".join(i.to_bytes(4, "little") for i in ids[p.start : p.start + p.length])
            assert p.start == next_id and p.ids_crc32 == zlib.crc32(data) and p.doc_tokens == len(ids)
            next_id += p.length
        assert next_id == len(ids)
    for parts in filled.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048


def test_the_whole_run(spark, folder, tmp_path):
    result = corpus_pipeline.run(spark, folder)
    texts = rows_of(queries.table(spark, folder, "documents"))
    at = queries.table(spark, folder, "documents").columns.index("text")
    pieces = result.collect()
    check_pieces(pieces, {p.doc_id: texts[p.doc_id] for p in pieces}, at)
    assert 0 < len({p.doc_id for p in pieces}) < len(texts)

    empty = str(tmp_path / "empty")
    queries.table(spark, folder, "documents").limit(0).write.parquet(f"{empty}/documents.parquet")
    for name in ("labels", "benchmark"):
        queries.table(spark, folder, name).write.parquet(f"{empty}/{name}.parquet")
    assert corpus_pipeline.run(spark, empty).collect() == []


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_long_texts_reach_python_in_small_batches(spark, folder, name, stage):
    """Rows of 50 kB: by their count alone all 200 of them would be one batch of 10 MB."""
    spark.conf.unset(common.BATCH)
    stage(spark, queries.table(spark, folder, "documents"), folder)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.nbytes], pa.int64())})

    long = spark.range(0, 200, 1, 1).select(F.repeat(F.lit("word "), 10_000).alias("text"))
    got = [r.n for r in long.mapInArrow(sizes, "n bigint").collect()]
    assert sum(got) >= 200 * 50_000 and max(got) <= 2 * common.BATCH_BYTES
