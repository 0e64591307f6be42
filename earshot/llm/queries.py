"""One query per operator over its whole table, and the SQL of those that have one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.llm import (
    backoff,
    differencing,
    hosts,
    infill,
    kernel,
    merges,
    packing,
    perspectives,
    pseudonyms,
    records,
    simhash,
    survival,
    threshold,
)
from earshot.llm.common import table

# Of the test tables only; a caller brings a secret of their own.
KEY = "key-of-the-test-tables"


# Of the public vocabulary that the token queries use.
VOCABULARY = "word_bpe_49k.json"
END_ID = 2


def _vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op1_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2
    return backoff.score(docs, held_out, backoff.file_block(docs))


def op2_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = pseudonyms.pseudonymized(table(spark, sf_dir, "documents"), KEY)
    return done.select(F.col("row.doc_id").alias("doc_id"), "text", "n_found", "n_replaced")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merges.digests(table(spark, sf_dir, "documents"), _vocabulary())


def op4_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = threshold.whole_numbers(table(spark, sf_dir, "embeddings"))
    return threshold.top_products(vectors, F.col("vec_id") % 100 == 0)


def op5_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = records.write(table(spark, sf_dir, "documents"), _vocabulary(), END_ID)
    return records.index(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def op6_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = perspectives.render(table(spark, sf_dir, "conversations"))
    return told.withColumn("masks", perspectives.spans(F.col("masks")))


def op7_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = hosts.judge(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return judged.select("row.doc_id", *hosts.MEASURES, "base_failed", "kept")


def op8_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return differencing.shard(table(spark, sf_dir, "documents"))


def op9_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _remainder(n: int):
    """Of the checksum of the id in decimals."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % n


def op11_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = _remainder(3) == 1
    scores = kernel.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out)
    return scores.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op12_survival(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survival.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = infill.fill_in_middle(table(spark, sf_dir, "documents"))
    return told.select(
        "doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infill.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_backoff, op2_pseudonyms, op3_bpe, op4_threshold, op5_records, op6_perspectives, op7_host_rules,
        op8_differencing, op9_best_fit, op10_simhash, op11_kernel, op12_survival, op13_infill,
    )
}

ORACLE = {
    "op4_threshold": f"""
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({threshold.SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score
FROM scored QUALIFY rank <= {threshold.K}""",
    "op6_perspectives": f"""
WITH turns AS (
  SELECT conv_id, turn, replace(coalesce(role, '{perspectives.NOBODY}'), '<|', '< |') AS name,
    replace(coalesce(text, ''), '<|', '< |') AS text FROM conversations
),
speakers AS (SELECT DISTINCT conv_id, name AS perspective FROM turns),
heads AS (
  SELECT t.*, perspective, name = perspective AS own,
    CASE WHEN name = perspective THEN '<|assistant|>' ELSE '<|user ' || name || '|>' END || chr(10) AS head
  FROM turns t JOIN speakers s ON t.conv_id IS NOT DISTINCT FROM s.conv_id
),
placed AS (
  SELECT *, head || text || '<|end|>' || chr(10) AS segment, length(segment) AS n,
    sum(n) OVER (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, name, text ROWS UNBOUNDED PRECEDING) - n AS start
  FROM heads
),
chunked AS (
  SELECT *, (start // {perspectives.CHUNK})::BIGINT AS chunk, min(start) OVER (PARTITION BY conv_id, perspective, chunk) AS first
  FROM placed
)
SELECT conv_id, perspective, chunk, min(start)::BIGINT AS start, count(*) AS n_turns,
  string_agg(segment, '' ORDER BY start) AS text,
  string_agg((start - first + length(head))::VARCHAR || '-' || (start - first + n)::VARCHAR, ',' ORDER BY start) FILTER (own) AS masks
FROM chunked GROUP BY conv_id, perspective, chunk""",
    "op7_host_rules": f"""
WITH cut AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents
),
windows AS (
  SELECT doc_id, pos, array_to_string(words[pos:pos + 4], ' ') AS win
  FROM cut, range(1, len(words) - 3) r(pos)
),
repeated AS (SELECT doc_id, pos FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
covered AS (
  SELECT doc_id, sum(least(5, pos - coalesce(before, pos - 5))) AS n FROM (
    SELECT doc_id, pos, lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM repeated
  ) GROUP BY doc_id
),
measured AS (
  SELECT doc_id, source, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM cut LEFT JOIN covered USING (doc_id)
),
judged AS (SELECT *, n_words < {hosts.MIN_WORDS} OR 100 * n_repeat_words > {hosts.MAX_REPEATED} * n_words AS base_failed FROM measured),
per_host AS (
  SELECT source, count(*) AS n, count(*) FILTER (base_failed) AS f FROM judged WHERE source IS NOT NULL GROUP BY source
),
sums AS (SELECT sum(f) / sum(n) AS mean, sum(f * f / n) / sum(n) AS squares, count(*) / sum(n) AS spread FROM per_host),
prior AS (
  SELECT mean, CASE WHEN mean * (1 - mean) <= 0 OR squares - mean * mean - mean * (1 - mean) * spread <= 0 THEN {hosts.STRONGEST_PRIOR}
    ELSE least({hosts.STRONGEST_PRIOR}, greatest(1, mean * (1 - mean) / (squares - mean * mean - mean * (1 - mean) * spread) - 1)) END AS strength
  FROM sums
),
rejected AS (SELECT source FROM per_host, prior WHERE (f + mean * strength) / (n + strength) > {hosts.MAX_FAILURES})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(source NOT IN (SELECT source FROM rejected), true) AS kept
FROM judged""",
    "op12_survival": f"""
WITH cut AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
  FROM documents
),
known AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
marked AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    (len(words) < {survival.MIN_WORDS})::INT + 2 * (100 * len(list_distinct(words)) < {survival.MIN_DISTINCT} * len(words))::INT
    + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > {survival.MAX_CAPITALS} * length(text))::INT
    + 8 * regexp_matches(text, '[#$%&*|]')::INT
    + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::INT AS failed
  FROM cut LEFT JOIN known USING (doc_id)
),
counted AS (
  SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM marked GROUP BY part, failed
),
letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(l, bit)),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
),
steps AS (
  SELECT filter_order, step::INT AS step, bit,
    (SELECT coalesce(sum(x.bit), 0)::INT FROM letters x WHERE contains(substr(filter_order, 1, step - 1), x.l)) AS before
  FROM orders, range(1, 6) r(step), letters WHERE l = substr(filter_order, step, 1)
),
placed AS (
  SELECT part, filter_order, step, s.bit, n, good, toxic, failed & before = 0 AS reached, failed & s.bit <> 0 AS fails, failed = s.bit AS alone
  FROM counted, steps s
),
summed AS (
  SELECT part, filter_order, step, any_value(bit) AS bit,
    coalesce(sum(n) FILTER (reached AND NOT fails), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (reached AND fails), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (fails AND NOT reached), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (alone), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (reached AND fails), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (reached AND fails), 0)::BIGINT AS toxic_lost
  FROM placed GROUP BY part, filter_order, step
)
SELECT * EXCLUDE (bit), (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM summed""",
    "op13_infill": f"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, ''))::BIGINT AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
),
numbered AS (
  SELECT *, ('0x' || h[1:8])::BIGINT % (n + 1) AS a, ('0x' || h[9:16])::BIGINT % (n + 1) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
        OR ('0x' || h[17:24])::BIGINT % 100 >= {infill.CUT} THEN 'plain'
      WHEN ('0x' || h[25:32])::BIGINT % 100 < {infill.SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
),
cut AS (
  SELECT *, substr(text, 1, least(a, b)) AS prefix, substr(text, 1 + least(a, b), abs(a - b)) AS middle, substr(text, 1 + greatest(a, b)) AS suffix
  FROM numbered
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN least(a, b) END AS prefix_chars, CASE WHEN form <> 'plain' THEN abs(a - b) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM cut""",
}
