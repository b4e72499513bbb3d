"""Queries over the driver tables: one for each operator, with SQL where it can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import (
    bpe,
    decontamination,
    exact_dedup,
    language_id,
    license_scan,
    line_dedup,
    ngram_join,
    packing,
    prefix_trie,
    spelling,
    token_count,
    toxicity,
    warc,
)
from starmart.session import shared_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Where a public tokenizer's file lies; the package is installed on the driver and the executors alike."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose sets of three-word shingles overlap by nine tenths."""
    found = ngram_join.join(table(spark, folder, "documents"), ngram_join.Rule(words=3, percent=90))
    return found.select("doc_id", "n_shingles", "component_id")


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document: which of its copies stays."""
    return exact_dedup.decisions(table(spark, folder, "documents"))


def digests(pieces: DataFrame) -> DataFrame:
    """Pieces with a checksum in place of their ids."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document in sequences of 2,048 ids, piece by piece."""
    return digests(packing.pack(table(spark, folder, "documents"), vocabulary("word_bpe_49k.json")))


def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licences named or quoted in every document."""
    found = license_scan.scan(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        F.size("matches").cast("bigint").alias("n_licenses"),
        F.array_join("matches.license", ",").alias("licenses"),
        F.coalesce(F.round(F.array_max("matches.dice"), 6), F.lit(0.0)).alias("best_dice"),
    )


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted language of every document."""
    return language_id.identify(table(spark, folder, "documents"))


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the lines that stand, within two edits, earlier in the corpus."""
    found = line_dedup.dedup(table(spark, folder, "documents"))
    kept = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    return found.select("doc_id", "n_lines", "n_dropped", kept.alias("kept_sha256"))


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that lie in benchmark passages."""
    found = decontamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    items = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(items.cast("binary"), 256).alias("items_sha256"), "contaminated"
    )


def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Writes every page into archives in the shared folder, reads them back and reports each record."""
    target = shared_path(spark, "warc")
    # The archives are written here, when the query is built: reading them is the query.
    warc.write(table(spark, folder, "pages"), target).write.format("noop").mode("overwrite").save()
    found = warc.read(spark, target).where("kind = 'record'")
    number = lambda c: F.when(F.col(c) != "None", F.col(c)).cast("bigint")
    return found.select(
        number("id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        number("refers_to").alias("refers_to"),
    )


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_token_count(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document under a unigram model of the documents, over the pieces of a public vocabulary."""
    return token_count.count_unigrams(table(spark, folder, "documents"), vocabulary("piece_bpe_32k.model"))


def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    """Frequent words one edit apart, under the most frequent form."""
    return spelling.group(table(spark, folder, "documents"), spelling.misspelled)


def op12_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Byte-level BPE ids of every document, and the text they decode to."""
    path = vocabulary("byte_bpe_50k.json")
    found = bpe.decode(bpe.encode(table(spark, folder, "documents"), path), path)
    return found.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Every distinct beginning of the rebuilt conversations."""
    rebuilt = prefix_trie.paths(
        table(spark, folder, "conversations"), lambda c: f"{c} - {c} % 5", prefix_trie.borrowed
    )
    return prefix_trie.trie(rebuilt)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_ngram_join,
        op2_exact_dedup,
        op3_packing,
        op4_license_scan,
        op5_language_id,
        op6_line_dedup,
        op7_decontamination,
        op8_warc,
        op9_toxicity,
        op10_token_count,
        op11_spelling,
        op12_bpe,
        op13_prefix_trie,
    )
}

ORACLES: dict[str, str] = {
    "op2_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS n,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
            FROM documents
        ), first AS (
            SELECT text_sha256, doc_id AS keep_id FROM d
            QUALIFY row_number() OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) = 1
        ), size AS (SELECT text_sha256, count(*) AS group_size FROM d GROUP BY text_sha256)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
        FROM d JOIN first USING (text_sha256) JOIN size USING (text_sha256)
    """,
    "op7_decontamination": r"""
        WITH words AS (
            SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
            FROM documents
        ), item_words AS (
            SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
            FROM benchmark
        ), item_windows AS (
            SELECT DISTINCT item_id, least(13, len(w)) AS size,
                   unnest(list_transform(range(1, len(w) - least(13, len(w)) + 2),
                          lambda i: array_to_string(w[i : i + least(13, len(w)) - 1], ' '))) AS win
            FROM item_words WHERE len(w) > 0
        ), sizes AS (SELECT DISTINCT size FROM item_windows),
        doc_windows AS (
            SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS pos,
                   unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i : i + size - 1], ' '))) AS win
            FROM words, sizes WHERE len(w) >= size
        ), hits AS (SELECT doc_id, item_id, pos, size FROM doc_windows JOIN item_windows USING (size, win)),
        hit_words AS (
            SELECT doc_id, count(DISTINCT pos + k) AS n_hit
            FROM (SELECT DISTINCT doc_id, pos, size FROM hits), LATERAL (SELECT unnest(range(0, size)) AS k) GROUP BY doc_id
        ), hit_items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
            FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
        )
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
    """,
    "op11_spelling": r"""
        WITH RECURSIVE crc AS (
            SELECT list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
                   lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)) AS codes
        ), runs AS (
            SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents
        ), counted AS (
            SELECT run, count(*) AS n, coalesce(doc_id::VARCHAR, '') || ':' || run AS named
            FROM runs WHERE length(run) >= 6 GROUP BY doc_id, run
        ), hashed AS (
            SELECT run, n, xor(4294967295, list_reduce([4294967295] || flatten(list_transform(range(1, length(named) + 1),
                   lambda i: CASE WHEN unicode(substr(named, i, 1)) < 128 THEN [unicode(substr(named, i, 1))]
                             ELSE [195, unicode(substr(named, i, 1)) - 64] END)),
                   lambda a, b: xor(a // 256, codes[xor(a % 256, b) + 1]))) AS h
            FROM counted, crc
        ), words AS (
            SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
                   sum(n)::BIGINT AS n
            FROM hashed GROUP BY 1 HAVING length(word) >= 6 AND sum(n) >= 5
        ), less AS (
            SELECT DISTINCT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
            FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)
        ), near AS (
            SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM less a JOIN less b USING (i, rest) WHERE a.word <> b.word
            UNION SELECT a.word, a.n, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
            UNION SELECT b.word, b.n, a.word, a.n FROM less a JOIN words b ON a.rest = b.word
        ), best AS (
            SELECT word, n, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n
            FROM near GROUP BY word, n
        ), forms AS (
            SELECT word, n_near, CASE WHEN other_n >= 5 * n THEN other END AS form, CASE WHEN other_n >= 5 * n THEN other_n END AS form_n
            FROM best
        ), chains AS (
            SELECT word, form AS top, 1 AS steps FROM forms WHERE form IS NOT NULL
            UNION ALL SELECT c.word, f.form, c.steps + 1 FROM chains c JOIN forms f ON f.word = c.top WHERE f.form IS NOT NULL
        ), roots AS (SELECT word, max_by(top, steps) AS root FROM chains GROUP BY word)
        SELECT word, form, coalesce(root, word) AS root, n, coalesce(n_near, 0) AS n_near, form_n
        FROM words LEFT JOIN forms USING (word) LEFT JOIN roots USING (word)
    """,
    "op13_prefix_trie": r"""
        WITH crc AS (
            SELECT list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
                   lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)) AS codes
        ), own AS (
            SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS turns
            FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
        ), heads AS (
            SELECT conv_id, turns, CAST(xor(4294967295, list_reduce(
                   [4294967295] || list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii(substr(conv_id::VARCHAR, i, 1))),
                   lambda a, b: xor(a // 256, codes[xor(a % 256, b) + 1]))) % 9 AS BIGINT) AS h
            FROM own, crc
        ), rebuilt AS (
            SELECT a.conv_id, list_concat(coalesce(b.turns, [])[1 : h], a.turns[h + 1 :]) AS turns
            FROM heads a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 5
        ), prefixes AS (
            SELECT conv_id, d, turns[1 : d] AS key, d = len(turns) AS ends
            FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)
        ), nodes AS (
            SELECT key, d, min(conv_id) AS conv_id, count(*) AS n,
                   sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
            FROM prefixes GROUP BY key, d
        ), children AS (SELECT key[1 : d - 1] AS key, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
        counted AS (
            SELECT nodes.*, coalesce(children.n, 0) AS n_children,
                   CASE WHEN d > 0 THEN (nodes.n - 1) * octet_length(encode(nodes.key[d].text)) ELSE 0 END AS saved
            FROM nodes LEFT JOIN children USING (key)
        ), sums AS (
            SELECT key[1 : top] AS key, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
            FROM (SELECT key, n_children, saved, unnest(range(0, d + 1)) AS top FROM counted) GROUP BY 1
        )
        SELECT c.conv_id, c.d AS depth, p.conv_id AS parent_conv_id, c.n AS n_convs, c.n_children, s.n_leaves,
               s.saved_tokens::BIGINT AS saved_tokens, c.ends_sha256
        FROM counted c JOIN sums s USING (key) LEFT JOIN nodes p ON c.d > 0 AND p.key = c.key[1 : c.d - 1]
    """,
}
