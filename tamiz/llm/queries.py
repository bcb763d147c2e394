"""Queries that apply each operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.llm.base import held_out, ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query, with the SQL that gives the same rows where SQL can."""
    def register(function):
        def run(spark, folder):
            ship_package(spark)
            return function(spark, folder)

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return function
    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op2_pivotal_mix")
def op2_pivotal_mix(spark, folder):
    from tamiz.llm.mixing import mix

    return mix(table(spark, folder, "documents"))


@query("op9_byte_bpe")
def op9_byte_bpe(spark, folder):
    import public_tokenizers

    from tamiz.llm import bpe

    vocabulary = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = table(spark, folder, "documents").select("doc_id", "text")
    done = bpe.decode(bpe.encode(docs, vocabulary, public_tokenizers.PATTERN), vocabulary)
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


@query("op3_chosen_path")
def op3_chosen_path(spark, folder):
    from tamiz.llm.chosen_path import near_duplicates

    return near_duplicates(table(spark, folder, "documents"), width=2, similarity=0.8)


@query("op10_warc_archive", r"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
""")
def op10_warc_archive(spark, folder):
    from tamiz.llm import warc
    from tamiz.session import fresh_path

    path = fresh_path(spark, "archive")
    warc.write_archive(table(spark, folder, "pages"), path)
    back = warc.read_archive(spark, path).withColumn("carried", warc.record_payload())
    field = lambda name: warc.header_field(F.col("warc_header"), name)
    return back.select(
        field("X-Page-ID").cast("long").alias("page_id"),
        F.octet_length("carried").cast("long").alias("payload_bytes"),
        F.sha2(F.col("carried"), 256).alias("payload_digest"),
        field("WARC-Type").alias("record_type"),
        field("X-Refers-To-Page").cast("long").alias("refers_to"),
    )


@query("op4_token_rollup", r"""
WITH d AS (
  SELECT source, lang, doc_id, min(doc_id) OVER (PARTITION BY text) AS first_id, text,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS words,
         coalesce(octet_length(encode(text)), 0)::BIGINT AS bytes
  FROM documents
), kept AS (SELECT * FROM d WHERE text IS NULL OR doc_id = first_id)
SELECT source, lang, 'words-v1' AS tokenizer, count(*)::BIGINT AS docs, sum(words)::BIGINT AS tokens FROM kept GROUP BY source, lang
UNION ALL
SELECT source, lang, 'bytes-v2' AS tokenizer, count(*)::BIGINT AS docs, sum(bytes)::BIGINT AS tokens FROM kept GROUP BY source, lang
""")
def op4_token_rollup(spark, folder):
    """Provisional counts come in, real counts revise them, exact copies go; one batch comes twice."""
    from tamiz.llm import rollup
    from tamiz.llm.mixing import word_count
    from tamiz.session import fresh_path, materialize

    docs = table(spark, folder, "documents")
    counted = materialize(
        docs.select(
            "doc_id", "source", "lang", F.sha2("text", 256).alias("digest"), word_count("text").alias("words"),
            F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"),
            F.ceil(F.coalesce(F.length("text"), F.lit(0)) / 5).alias("guess"),
        ),
        "token-counts",
    )
    firsts = counted.filter("digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("first_id"))
    copies = counted.join(firsts, "digest").filter("doc_id <> first_id")
    sums = rollup.TokenRollup(spark, fresh_path(spark, "rollup"))
    column = F.col
    sums.commit("1-load", rollup.changes(counted, column("guess"), 1, "words-v1"),
                rollup.changes(counted, column("bytes"), 1, "bytes-v2"))
    recount = rollup.revisions(counted, column("guess"), column("words"), "words-v1")
    sums.commit("2-recount", recount)
    sums.commit("3-copies", rollup.changes(copies, column("words"), -1, "words-v1"),
                rollup.changes(copies, column("bytes"), -1, "bytes-v2"))
    sums.commit("2-recount", recount)
    return sums.totals()


@query("op8_multi_index_hashing")
def op8_multi_index_hashing(spark, folder):
    from tamiz.llm.hamming_index import nearest

    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return nearest(vectors.filter(F.col("vec_id") % 100 == 0), vectors, k=10)


@query("op1_imatch")
def op1_imatch(spark, folder):
    from tamiz.llm import imatch

    docs = table(spark, folder, "documents").select("doc_id", "text")
    return imatch.edited_fingerprints(docs, imatch.lexicon(docs))


@query("op5_segmentation_unigrams")
def op5_segmentation_unigrams(spark, folder):
    import public_tokenizers

    from tamiz.llm import unigram_language as language

    docs = table(spark, folder, "documents")
    pieces = language.load_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    model = language.fit(docs, pieces, ~held_out("doc_id", 5, 0))
    named = docs.select("doc_id", "text", held_out("doc_id", 5, 0).alias("held_out"))
    return language.identify(named, model).drop("text")


@query("op7_random_indexing")
def op7_random_indexing(spark, folder):
    from tamiz.llm import random_index

    docs = table(spark, folder, "documents")
    model = random_index.fit(docs, table(spark, folder, "labels"), ~held_out("doc_id", 4, 2))
    named = docs.select("doc_id", "text", held_out("doc_id", 4, 2).alias("held_out"))
    scored = random_index.classify(named, model).drop("text")
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.7, 1).otherwise(0))


@query("op6_attention_lm")
def op6_attention_lm(spark, folder):
    import public_tokenizers

    from tamiz.llm import attention_lm, bpe

    vocabulary = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = table(spark, folder, "documents")
    return attention_lm.score_documents(docs, vocabulary, public_tokenizers.PATTERN, ~held_out("doc_id", 10, 0))


@query("op11_dialogue_repair", r"""
WITH RECURSIVE bits AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8),
         lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS tbl
), keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '') AS key
  FROM conversations
), hit AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(list_transform(key, lambda c: ascii(c)::BIGINT),
         lambda a, b: xor(a >> 8, tbl[(xor(a, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) % 20 AS kind
  FROM keyed, bits
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hit, range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END) AS copies
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM damaged
), judged AS (
  SELECT *, left(role, 1) AS initial, rtrim(text, e' \t\n\x0b\f\r') AS body,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) AS seen,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS earlier
  FROM placed
), faults AS (
  SELECT *, CASE WHEN body = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate'
                 WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault
  FROM judged
), counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (earlier IS NOT NULL AND earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id
), dp AS (
  SELECT conv_id, n AS pos, {'c': 0, 'a': '', 'o': []::VARCHAR[]} AS b0,
         {'c': 4, 'a': 'II', 'o': ['user:', 'assistant:']} AS b1, {'c': 2, 'a': 'I', 'o': ['assistant:']} AS b2,
         {'c': 0, 'a': '', 'o': []::VARCHAR[]} AS b3
  FROM counts
  UNION ALL
  SELECT conv_id, pos, list_min([c0, {'c': 2 + b2.c, 'a': 'I' || b2.a, 'o': ['user:'] || b2.o}]) AS b0,
         list_min([c1, {'c': 2 + b2.c, 'a': 'I' || b2.a, 'o': ['user:'] || b2.o}]) AS b1, b2,
         list_min([c3, {'c': 2 + c2.c, 'a': 'I' || c2.a, 'o': ['user:'] || c2.o}]) AS b3
  FROM (
    SELECT *, list_min([c2, {'c': 2 + c3.c, 'a': 'I' || c3.a, 'o': ['assistant:'] || c3.o}]) AS b2
    FROM (
      SELECT d.conv_id, d.pos - 1 AS pos,
             list_min([{'c': 3 + b0.c, 'a': 'D' || b0.a, 'o': b0.o},
                       CASE WHEN stays AND initial = 's' THEN {'c': cut + b1.c, 'a': 'K' || b1.a, 'o': line || b1.o} END,
                       CASE WHEN stays AND initial = 'u' THEN {'c': cut + b2.c, 'a': 'K' || b2.a, 'o': line || b2.o} END,
                       CASE WHEN stays THEN {'c': 2 + cut + b2.c, 'a': 'R' || b2.a, 'o': ['user:' || text] || b2.o} END]) AS c0,
             list_min([{'c': 3 + b1.c, 'a': 'D' || b1.a, 'o': b1.o},
                       CASE WHEN stays AND initial = 'u' THEN {'c': cut + b2.c, 'a': 'K' || b2.a, 'o': line || b2.o} END,
                       CASE WHEN stays THEN {'c': 2 + cut + b2.c, 'a': 'R' || b2.a, 'o': ['user:' || text] || b2.o} END]) AS c1,
             list_min([{'c': 3 + b2.c, 'a': 'D' || b2.a, 'o': b2.o},
                       CASE WHEN stays AND initial = 'a' THEN {'c': cut + b3.c, 'a': 'K' || b3.a, 'o': line || b3.o} END,
                       CASE WHEN stays THEN {'c': 2 + cut + b3.c, 'a': 'R' || b3.a, 'o': ['assistant:' || text] || b3.o} END]) AS c2,
             list_min([{'c': 3 + b3.c, 'a': 'D' || b3.a, 'o': b3.o},
                       CASE WHEN stays AND initial = 'u' THEN {'c': cut + b2.c, 'a': 'K' || b2.a, 'o': line || b2.o} END,
                       CASE WHEN stays THEN {'c': 2 + cut + b2.c, 'a': 'R' || b2.a, 'o': ['user:' || text] || b2.o} END]) AS c3
      FROM dp d JOIN (
        SELECT *, [role || ':' || text] AS line, (fault IS NOT NULL AND fault = 'truncated')::INT AS cut,
               fault IS NULL OR fault = 'truncated' AS stays
        FROM faults
      ) f ON f.conv_id IS NOT DISTINCT FROM d.conv_id AND f.pos = d.pos
    )
  )
)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b0.c, 0)::BIGINT AS cost,
       coalesce(b0.a, '') AS audit, sha256(coalesce(array_to_string(b0.o, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM i.conv_id
LEFT JOIN dp d ON d.conv_id IS NOT DISTINCT FROM i.conv_id AND d.pos = 0
""")
def op11_dialogue_repair(spark, folder):
    from tamiz.llm import dialogue

    return dialogue.repair(dialogue.damage(table(spark, folder, "conversations")))


@query("op12_packed_ids")
def op12_packed_ids(spark, folder):
    import public_tokenizers

    from tamiz.llm import packed_ids
    from tamiz.session import fresh_path

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as lines:
        definition = lines.read()
    path = fresh_path(spark, "packed")
    # This tokenizer's tokens never hold a blank, so words may be encoded one by one.
    ordered = packed_ids.in_order(table(spark, folder, "documents"))
    packed_ids.write_documents(ordered, path, definition, end=1, by_word=True)
    return packed_ids.document_digests(packed_ids.read_pieces(spark, path))


@query("op13_best_position", r"""
WITH terms AS (
  SELECT r, doc_id, unnest(ts) AS term, len(ts)::BIGINT AS n FROM (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents)
), totals AS (
  SELECT count(DISTINCT r)::BIGINT AS docs, count(*)::BIGINT AS total FROM terms
), postings AS (
  SELECT r, doc_id, term, n, count(*)::BIGINT AS tf FROM terms GROUP BY ALL
), dfs AS (SELECT term, count(*)::BIGINT AS df FROM postings GROUP BY term),
weighed AS (
  SELECT r, doc_id, term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT
         * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * docs) // total)))) AS part
  FROM postings JOIN dfs USING (term), totals
), asked AS (
  SELECT i, item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS i, * FROM benchmark)
), scored AS (
  SELECT i, item_id, r, doc_id, sum(part)::BIGINT AS score FROM asked JOIN weighed USING (term) GROUP BY ALL
)
SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= 20
""")
def op13_best_position(spark, folder):
    from tamiz.llm import ranked_search

    return ranked_search.search(table(spark, folder, "benchmark"), table(spark, folder, "documents"), k=20)
