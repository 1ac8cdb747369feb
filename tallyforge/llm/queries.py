"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import corpus_pipeline
from tallyforge.llm.bin_packing import packed
from tallyforge.llm.chaining import shared_passages
from tallyforge.llm.difference_cover import without_earlier_strings
from tallyforge.llm.edit_join import near_lines
from tallyforge.llm.embedding_lsh import contained_items
from tallyforge.llm.hyper_minhash import near_duplicates
from tallyforge.llm.importance import resampled
from tallyforge.llm.line_frequency import judged
from tallyforge.llm.overlap_counts import count_tokens
from tallyforge.llm.skip_chain import personal_data
from tallyforge.llm.stripes import collocations
from tallyforge.llm.trie_bpe import encode_and_decode
from tallyforge.llm.whitening import whitened
from tallyforge.registry.catalog import Catalog, Entry
from tallyforge.sources.tables import Tables

catalog = Catalog()


def entries() -> dict[str, Entry]:
    return catalog.entries


def _word_bpe() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


@catalog.query()
def op1_token_counts(t: Tables) -> DataFrame:
    counted = count_tokens(t.documents, _word_bpe())
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)


_LINKS_SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w
    FROM documents),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS shingle
             FROM (SELECT doc_id, w, unnest(range(1, GREATEST(len(w) - 2, 2))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, COUNT(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, COUNT(*) AS hits FROM shingles a JOIN shingles b USING (shingle)
           WHERE a.doc_id < b.doc_id GROUP BY x, y),
links AS (SELECT x, y FROM shared JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y WHERE 100 * hits >= 80 * (s.n + t.n - hits)),
ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, w.y FROM reached r JOIN ways w ON r.other = w.x),
parts AS (SELECT doc_id, MIN(other) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, CAST(COALESCE(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN parts USING (doc_id) LEFT JOIN sizes USING (doc_id)"""


@catalog.query(_LINKS_SQL)
def op2_near_duplicates(t: Tables) -> DataFrame:
    return near_duplicates(t.documents, words=4).withColumn("kept", F.col("doc_id") == F.col("component_id"))


_RULES_SQL = r"""
WITH docs AS (SELECT doc_id, source, COALESCE(text, '') AS text FROM documents),
words AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs),
windows AS (SELECT doc_id, i, w[i] || chr(1) || w[i + 1] || chr(1) || w[i + 2] AS three
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words)),
twice AS (SELECT doc_id, i FROM (SELECT *, COUNT(*) OVER (PARTITION BY doc_id, three) AS n FROM windows) WHERE n > 1),
covered AS (SELECT doc_id, COUNT(DISTINCT i + k) AS n FROM twice, (SELECT unnest(range(3)) AS k) GROUP BY doc_id),
raw AS (SELECT doc_id, source, text, line, no
        FROM (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS no FROM docs)
        WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
again AS (SELECT doc_id, COUNT(*) - COUNT(DISTINCT line) AS n FROM raw GROUP BY doc_id),
lines AS (SELECT doc_id, source, no, array_to_string(regexp_extract_all(lower(line), '[^\x20\x09-\x0D]+'), ' ') AS line FROM raw),
-- Documents with the same lines are one.
same AS (SELECT docs.doc_id, docs.source, COALESCE(string_agg(line, chr(10) ORDER BY no), '') AS own FROM docs LEFT JOIN lines USING (doc_id) GROUP BY ALL),
total AS (SELECT source, GREATEST(20.0, 0.01 * COUNT(DISTINCT own)) AS most FROM same GROUP BY source),
over_limit AS (SELECT l.source, line FROM lines l JOIN same s USING (doc_id) JOIN total t ON l.source IS NOT DISTINCT FROM t.source
               GROUP BY l.source, line, most HAVING COUNT(DISTINCT own) > most),
removed AS (SELECT doc_id, SUM(len(string_split(a.line, ' '))) AS n FROM lines a JOIN over_limit o ON a.source IS NOT DISTINCT FROM o.source AND a.line = o.line
            GROUP BY doc_id),
measured AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
                    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                    CAST(COALESCE(again.n, 0) AS BIGINT) AS n_dup_lines, CAST(COALESCE(covered.n, 0) AS BIGINT) AS n_repeat_words,
                    CAST(COALESCE(removed.n, 0) AS BIGINT) AS n_removed_words
             FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN again USING (doc_id) LEFT JOIN removed USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * (n_words - n_removed_words) >= 50 * n_words AS kept
FROM measured"""


@catalog.query(_RULES_SQL)
def op3_quality_rules(t: Tables) -> DataFrame:
    return judged(t.documents).drop("cleaned")


@catalog.query()
def op6_contained_items(t: Tables) -> DataFrame:
    return contained_items(t.documents, t.benchmark)


@catalog.query()
def op9_importance_resampling(t: Tables) -> DataFrame:
    # Good labels as the target; as large a share is drawn as documents have good quality among the labelled.
    share = t.labels.agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0] or 0.0
    target = t.labels.filter("quality = 1 AND toxic = 0")
    return resampled(t.documents, target, share)


@catalog.query()
def op10_bpe_roundtrip(t: Tables) -> DataFrame:
    coded = encode_and_decode(t.documents, _word_bpe())
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@catalog.query(sql=corpus_pipeline.ORACLE_SQL)
def pipeline(t: Tables) -> DataFrame:
    return corpus_pipeline.run(t.spark, t.base)


@catalog.query()
def op4_near_lines(t: Tables) -> DataFrame:
    found = near_lines(t.documents)
    return found.withColumnsRenamed({"class_key": "class_doc_id"})


@catalog.query()
def op8_packed_shards(t: Tables) -> DataFrame:
    placed = packed(t.documents, 24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@catalog.query()
def op5_shared_passages(t: Tables) -> DataFrame:
    return shared_passages(t.documents)


_REPEATS_SQL = """
WITH docs AS (SELECT doc_id, hex(encode(COALESCE(text, ''))) AS h FROM documents),
strings AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s
            FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS i FROM docs)),
starts AS (SELECT doc_id, i FROM (SELECT doc_id, i, MIN(doc_id) OVER (PARTITION BY s) AS least FROM strings) WHERE least < doc_id),
islands AS (SELECT doc_id, i, SUM(opens) OVER (PARTITION BY doc_id ORDER BY i) AS island
            FROM (SELECT doc_id, i, CASE WHEN i <= LAG(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS opens FROM starts)),
spans AS (SELECT doc_id, MIN(i) AS a, MAX(i) + 50 AS b FROM islands GROUP BY doc_id, island),
pieces AS (SELECT doc_id, a, b, COALESCE(LAG(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS done FROM spans),
cut AS (SELECT p.doc_id, SUM(b - a) AS removed, COUNT(*) AS n, MAX(b) AS last,
               string_agg(substr(h, 2 * done + 1, 2 * (a - done)), '' ORDER BY a) AS kept
        FROM pieces p JOIN docs USING (doc_id) GROUP BY p.doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(COALESCE(removed, 0) AS BIGINT) AS n_removed,
       CAST(COALESCE(n, 0) AS BIGINT) AS n_spans,
       sha256(unhex(COALESCE(kept, '') || substr(h, 2 * COALESCE(last, 0) + 1))) AS kept_sha256
FROM docs LEFT JOIN cut USING (doc_id)"""


@catalog.query(_REPEATS_SQL)
def op7_repeated_bytes(t: Tables) -> DataFrame:
    found = without_earlier_strings(t.documents)
    return found.select(
        "doc_id",
        "n_bytes",
        F.aggregate("removed", F.lit(0).cast("long"), lambda total, span: total + span["stop"] - span["start"]).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


_PHRASES_SQL = r"""
WITH pieces AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
    FROM (SELECT COALESCE(lang, 'und') AS lang,
                 unnest(regexp_split_to_array(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[.,;:!?\x0A-\x0D]')) AS piece
          FROM documents)),
grams AS (SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS phrase, COUNT(*) AS f
          FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM pieces, (SELECT unnest(range(1, 5)) AS m))
          GROUP BY ALL),
found AS (SELECT lang, m, phrase, f, string_split(phrase, ' ') AS w FROM grams WHERE m > 1 AND f >= 30),
inside AS (SELECT lang, array_to_string(w[i : i + s - 1], ' ') AS phrase, MAX(f) AS widest
           FROM (SELECT lang, w, f, s, unnest(range(1, m - s + 2)) AS i FROM found, (SELECT unnest([2, 3]) AS s) WHERE s < m) GROUP BY ALL),
cuts AS (SELECT c.lang, c.phrase, c.f AS a, k, array_to_string(w[1 : k], ' ') AS x, array_to_string(w[k + 1 : ], ' ') AS y
         FROM (SELECT *, unnest(range(1, m)) AS k FROM found) c LEFT JOIN inside i ON c.lang = i.lang AND c.phrase = i.phrase
         WHERE 100 * COALESCE(widest, 0)::HUGEINT < 80 * c.f::HUGEINT),
scored AS (SELECT c.lang, c.phrase, a, k, p.f AS l, q.f AS r, (2000000::HUGEINT * a) // (p.f + q.f) AS score
           FROM cuts c JOIN grams p ON c.lang = p.lang AND c.x = p.phrase JOIN grams q ON c.lang = q.lang AND c.y = q.phrase),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
sizes AS (SELECT lang, SUM(f) AS n FROM grams WHERE m = 1 GROUP BY lang)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM lowest JOIN sizes USING (lang) QUALIFY rank <= 2000"""


@catalog.query(_PHRASES_SQL)
def op11_stripe_collocations(t: Tables) -> DataFrame:
    return collocations(t.documents)


@catalog.query()
def op12_skip_chain_pii(t: Tables) -> DataFrame:
    found = personal_data(t.documents)
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


@catalog.query()
def op13_embedding_whitening(t: Tables) -> DataFrame:
    return whitened(t.embeddings)
