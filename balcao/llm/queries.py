"""One query per operator over the given tables, and SQL where it can express one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from balcao.llm import chat, decontam, langid, mixing, neardup, packing, pii, quality, suffix, tokens, treap, trie, warc

MOST_TOKENS = 4096
#: The conversation that holds the template's own control strings.
TRICKY = "\\### Assistant: </turn> ok"


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_language_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_read(spark, sf_dir, "documents"))


def op2_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_read(spark, sf_dir, "documents"))


def op3_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = warc.marked(_read(spark, sf_dir, "pages"))
    listed = warc.write_archives(rows, warc.archive_folder(spark))
    return warc.read_archives(listed, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op4_winnowing_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.overlaps(docs, _read(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontam.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def op5_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(docs, mixing.root_weights(docs)).select("row.doc_id", "row.source", "block", "slot", "place")


def op6_bpe_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.token_counts(_read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), MOST_TOKENS)


def op7_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymize(_read(spark, sf_dir, "documents"), pii.key_of(spark))


def op8_prefix_target_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.range(2).select(
        F.lit(-7).cast(turns.schema["conv_id"].dataType).alias("conv_id"),
        F.col("id").cast(turns.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(TRICKY).alias("text"),
    )
    return chat.read_back(chat.examples(turns.unionByName(tricky)))


def op9_bottom_k_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_read(spark, sf_dir, "documents"), shingle=4, percent=80)


def op10_longest_previous_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(_read(spark, sf_dir, "documents"), keep_first=False).drop("kept_text")


def _rebuilt(listed: DataFrame) -> DataFrame:
    """Conversations that begin as the first of their five does, for as many turns as their id's checksum says."""
    c = F.col("conv_id")
    starts = listed.select(c.alias("base"), F.slice("path", 1, 8).alias("start"))
    h = (F.crc32(F.encode(c.cast("string"), "utf-8")) % 9).cast("int")
    rows = listed.withColumns({"base": c - c % 5, "h": h}).join(starts, "base", "left")
    own = F.slice("path", F.col("h") + 1, F.greatest(F.size("path") - F.col("h"), F.lit(0)))
    shared = F.when(F.col("start").isNotNull(), F.slice("start", F.lit(1), F.col("h"))).otherwise(F.slice("path", F.lit(1), F.lit(0)))
    return rows.select("conv_id", F.concat(shared, own).alias("path"))


def op11_parenthesis_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie(_rebuilt(trie.paths(_read(spark, sf_dir, "conversations"))))


def op12_treap_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    built, n_docs = treap.index(_read(spark, sf_dir, "documents"))
    return treap.search(built, n_docs, _read(spark, sf_dir, "benchmark"), 20)


def op13_genetic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    found = packing.pieces(_read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), MOST_TOKENS, 1)
    return packing.pack(found, MOST_TOKENS)


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_profiles, op2_quality_cascade, op3_warc_zstd, op4_winnowing_decontamination, op5_pfair_mixing,
        op6_bpe_token_counts, op7_feistel_pseudonyms, op8_prefix_target_chat, op9_bottom_k_near_duplicates,
        op10_longest_previous_factors, op11_parenthesis_trie, op12_treap_search, op13_genetic_packing,
    )
}

_QUALITY = r"""
WITH w AS (
  SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS times
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)
), repeats AS (
  SELECT doc_id, count(DISTINCT pos) AS n
  FROM (SELECT doc_id, unnest(range(i, i + 3)) AS pos FROM windows WHERE times > 1) GROUP BY doc_id
), top AS (
  SELECT doc_id, max(n) AS n FROM (
    SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(words) AS word FROM w) GROUP BY doc_id, word
  ) GROUP BY doc_id
), m AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words,
         length(array_to_string(words, ''))::BIGINT AS word_chars,
         length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(repeats.n, 0)::BIGINT AS n_repeat_words,
         len(lines) AS n_lines, coalesce(top.n, 0) AS top_word,
         length(regexp_replace(coalesce(text, ''), '[^A-Z]', '', 'g')) AS n_upper,
         len(list_filter(words, lambda x: NOT regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) AS n_mute
  FROM w LEFT JOIN repeats USING (doc_id) LEFT JOIN top USING (doc_id)
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (
         10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words
         OR 100 * n_dup_lines > 50 * n_lines OR 100 * n_upper > 30 * word_chars
         OR 100 * top_word > 30 * n_words OR 100 * n_mute > 30 * n_words) AS kept
FROM b
"""

_WARC = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), k AS (SELECT html, max(page_id) AS keeper FROM p GROUP BY html)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((('0x' || substr(hex, (i // 8) * 10 + 1, 10))::BIGINT >> (5 * (7 - i % 8))::BIGINT) & 31) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM p JOIN k USING (html)
"""

_DECONTAMINATION = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, size, array_to_string(words[pos : pos + size - 1], ' ') AS said
  FROM (SELECT item_id, words, least(13, len(words)) AS size, unnest(range(1, len(words) - least(13, len(words)) + 2)) AS pos
        FROM i WHERE len(words) > 0)
), runs AS (
  SELECT doc_id, size, pos, array_to_string(words[pos : pos + size - 1], ' ') AS said
  FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS pos
        FROM d, (SELECT DISTINCT size FROM windows) WHERE len(words) >= size)
), hits AS (
  SELECT doc_id, pos, size, item_id FROM runs JOIN windows USING (size, said)
), covered AS (
  SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS place FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(covered.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256,
       coalesce(covered.n, 0) > 0 AND 20 * coalesce(covered.n, 0) >= len(words) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_MIXING = """
WITH RECURSIVE sizes AS (
  SELECT source, floor(sqrt(count(*)::DOUBLE) * 1000)::BIGINT AS weight FROM documents GROUP BY source
), numbered AS (
  SELECT source, weight, row_number() OVER (ORDER BY source NULLS FIRST) AS which,
         (count(*) + 31) // 32 AS blocks FROM documents JOIN sizes USING (source) WHERE weight > 0 GROUP BY source, weight
  UNION ALL BY NAME
  SELECT NULL AS source, any_value(s.weight) AS weight, 0 AS which, (count(*) + 31) // 32 AS blocks
  FROM documents d JOIN sizes s ON s.source IS NULL WHERE d.source IS NULL AND s.weight > 0 HAVING count(*) > 0
), p AS (
  SELECT sum(weight)::BIGINT AS total, list(weight ORDER BY which) AS weights,
         max((blocks * (SELECT sum(weight) FROM numbered) + weight - 1) // weight)::BIGINT AS slots FROM numbered
), run(t, done, chosen) AS (
  SELECT 0::BIGINT, list_transform(weights, lambda x: 0::BIGINT), 0::BIGINT FROM p
  UNION ALL
  SELECT t + 1, list_transform(range(1, len(weights) + 1), lambda k: done[k] + CASE WHEN k = pick THEN 1 ELSE 0 END), pick
  FROM (
    SELECT t, done, weights, list_min(list_transform(range(1, len(weights) + 1), lambda k:
      CASE WHEN done[k] * total // weights[k] <= t THEN (((done[k] + 1) * total + weights[k] - 1) // weights[k]) * 1000000 + k END
    )) % 1000000 AS pick
    FROM run, p WHERE t < slots
  )
), placed AS (
  SELECT chosen AS which, t - 1 AS slot, row_number() OVER (PARTITION BY chosen ORDER BY t) - 1 AS nth FROM run WHERE t > 0
), rows AS (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id) - 1 AS number
  FROM documents
)
SELECT doc_id, rows.source, number // 32 AS block, slot, (number % 32)::BIGINT AS place
FROM rows JOIN (SELECT *, row_number() OVER (ORDER BY which) AS nr FROM numbered) n ON rows.source IS NOT DISTINCT FROM n.source
JOIN placed ON placed.which = n.nr AND placed.nth = number // 32
"""

_CHAT = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL
  SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), e AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS nth,
         count(*) OVER (PARTITION BY conv_id) AS n,
         length(replace(replace(replace(replace(role, '\', '\\'), '</turn>', '<\/turn>'), '### ', '#\## '), ': ', ':\ '))
         + length(replace(replace(replace(text, '\', '\\'), '</turn>', '<\/turn>'), '### ', '#\## ')) + 15 AS size
  FROM t
), s AS (
  SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY nth) AS upto FROM e
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth)) AS turns_sha256,
       length(coalesce(string_agg(text, '' ORDER BY nth) FILTER (role = 'assistant'), ''))::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY nth) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(upto) FILTER (role = 'assistant' OR nth = n)::BIGINT AS formatted_chars
FROM s GROUP BY conv_id
"""

_TRIE = r"""
WITH t AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS path
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), h AS (
  SELECT conv_id, path, conv_id - conv_id % 5 AS base,
    (xor(list_reduce(list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT), lambda crc, b:
      list_reduce([0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(crc, b)),
      4294967295::BIGINT), 4294967295) % 9)::INT AS h
  FROM t
), r AS (
  SELECT h.conv_id, list_concat(coalesce(b.path[1:h.h], []), h.path[h.h + 1:]) AS path FROM h LEFT JOIN t b ON b.conv_id = h.base
), n AS (
  SELECT path[1:d] AS prefix, d AS depth, min(conv_id) AS conv_id, count(*)::BIGINT AS n_convs,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(path) = d), '') AS ends
  FROM (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS d FROM r) GROUP BY ALL
), k AS (
  SELECT prefix[1:depth - 1] AS prefix, count(*)::BIGINT AS n_children FROM n WHERE depth > 0 GROUP BY ALL
), w AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * coalesce(strlen(prefix[depth].text), 0) AS saved
  FROM n LEFT JOIN k USING (prefix)
), s AS (
  SELECT top AS prefix, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM (SELECT prefix[1:e] AS top, n_children, saved FROM (SELECT *, unnest(range(0, depth + 1)) AS e FROM w)) GROUP BY ALL
)
SELECT w.conv_id, w.depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, n_leaves, saved_tokens, sha256(w.ends) AS ends_sha256
FROM w JOIN s USING (prefix) LEFT JOIN n p ON w.depth > 0 AND p.depth = w.depth - 1 AND p.prefix = w.prefix[1:w.depth - 1]
"""

_SEARCH = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents WHERE text IS NOT NULL
), a AS (
  SELECT count(*)::BIGINT AS n_docs, sum(len(words))::BIGINT AS n_terms FROM d WHERE len(words) > 0
), q AS (
  SELECT item_id, word, count(*)::BIGINT AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS word FROM benchmark) GROUP BY ALL
), tf AS (
  SELECT doc_id, word, count(*)::BIGINT AS tf FROM (SELECT doc_id, unnest(words) AS word FROM d)
  WHERE word IN (SELECT word FROM q) GROUP BY ALL
), w AS (
  SELECT word, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT word, count(*)::BIGINT AS df FROM tf GROUP BY word), a
), m AS (
  SELECT doc_id, (75 + (25 * len(words)::BIGINT * n_docs) // n_terms)::BIGINT AS m FROM d, a WHERE len(words) > 0
), s AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM q JOIN tf USING (word) JOIN w USING (word) JOIN m USING (doc_id) GROUP BY ALL
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 20
"""

SQL = {
    "op2_quality_cascade": _QUALITY,
    "op3_warc_zstd": _WARC,
    "op4_winnowing_decontamination": _DECONTAMINATION,
    "op5_pfair_mixing": _MIXING,
    "op8_prefix_target_chat": _CHAT,
    "op11_parenthesis_trie": _TRIE,
    "op12_treap_search": _SEARCH,
}
