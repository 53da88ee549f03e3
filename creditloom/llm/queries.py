"""The registered queries of the subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.llm import (
    chat,
    conversation_trie,
    embed_dedup,
    licenses,
    minhash,
    mixing,
    neighbours,
    packing,
    page_text,
    phrases,
    quality,
    token_counts,
    warc,
)
from creditloom.sources.shared import shared_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def license_scan(spark, sf):
    return licenses.scan(table(spark, sf, "documents"))


def embedding_near_dedup(spark, sf):
    return embed_dedup.near_duplicates(table(spark, sf, "embeddings"), least_cosine=0.98)


def html_extraction(spark, sf):
    return page_text.extract(table(spark, sf, "pages"))


def source_mixing(spark, sf):
    return mixing.taken_words(
        table(spark, sf, "documents"), weights=(3, 1, 2), scale=1.5, most=2
    )


def nearest_neighbours(spark, sf):
    return neighbours.nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def warc_round_trip(spark, sf):
    """Every page written to archives and read back; the archives stay in the shared folder."""
    folder = shared_folder(spark, "warc")
    warc.write_archive(table(spark, sf, "pages"), folder)
    return warc.read_archive(spark, folder, with_payload=False).select(
        "page_id",
        "payload_bytes",
        F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        "refers_to",
        "error",
    )


# A conversation whose texts hold control strings of the template.
TRICKY = "</s>[INST] ok [/INST]"


def chat_formatting(spark, sf):
    columns = ["conv_id", "turn", "role", "text"]
    rows = table(spark, sf, "conversations").select(*columns)
    tricky = spark.createDataFrame(
        [(-1, 0, "user", TRICKY), (-1, 1, "assistant", TRICKY)], rows.schema
    )
    return chat.digests(chat.format_conversations(rows.unionAll(tricky)))


def quality_classifier(spark, sf):
    return quality.classified(table(spark, sf, "documents"), table(spark, sf, "labels"))


def vocabulary() -> dict[str, str]:
    """The files and the splitting pattern of the 50k byte vocabulary."""
    import public_tokenizers

    return {
        "ranks_path": str(public_tokenizers.path("byte_bpe_50k.tiktoken")),
        "pattern": public_tokenizers.PATTERN,
        "tokenizer_path": str(public_tokenizers.path("byte_bpe_50k.json")),
    }


def mixture_packing(spark, sf):
    return packing.pack(table(spark, sf, "documents"), **vocabulary())


def minhash_dedup(spark, sf):
    return minhash.near_duplicates(table(spark, sf, "documents"), k=2, percent=80)


def phrase_collocations(spark, sf):
    return phrases.collocations(table(spark, sf, "documents"), least=10, share=50, top=2000)


def conversation_prefix_trie(spark, sf):
    return conversation_trie.prefix_trie(table(spark, sf, "conversations"))


def document_token_counts(spark, sf):
    return token_counts.token_counts(
        table(spark, sf, "documents"), vocabulary()["tokenizer_path"], limit=512
    )


# All notices in canonical form, from lists of their own; licences in full are left to tests, as none of
# the tables' documents is one.
LICENSE_SQL = r"""
WITH subjects(subject) AS (VALUES
  (''), ('this work is '), ('this file is '), ('this software is '), ('this document is ')),
verbs(verb) AS (VALUES
  ('licensed'), ('released'), ('distributed'), ('made available'), ('published')),
articles(article) AS (VALUES (''), ('the '), ('a '), ('the terms of the ')),
openings AS (
  SELECT subject || verb || ' under ' || article AS opening FROM subjects, verbs, articles
  UNION ALL
  SELECT opening FROM (VALUES ('spdx license identifier '), ('license ')) AS v(opening)),
names(name, license_id) AS (VALUES
  ('mit license', 'MIT'), ('mit', 'MIT'), ('isc license', 'ISC'), ('isc', 'ISC'),
  ('bsd 2 clause license', 'BSD-2-Clause'), ('bsd 2 clause', 'BSD-2-Clause'),
  ('simplified bsd license', 'BSD-2-Clause'),
  ('bsd 3 clause license', 'BSD-3-Clause'), ('bsd 3 clause', 'BSD-3-Clause'),
  ('new bsd license', 'BSD-3-Clause'),
  ('apache license version 2 0', 'Apache-2.0'), ('apache license 2 0', 'Apache-2.0'),
  ('apache 2 0 license', 'Apache-2.0'), ('apache 2 0', 'Apache-2.0'),
  ('mozilla public license version 2 0', 'MPL-2.0'), ('mozilla public license 2 0', 'MPL-2.0'),
  ('mpl 2 0', 'MPL-2.0'),
  ('gnu general public license version 2', 'GPL-2.0'), ('gnu gpl v2', 'GPL-2.0'),
  ('gplv2', 'GPL-2.0'), ('gpl 2 0', 'GPL-2.0'),
  ('gnu general public license version 3', 'GPL-3.0'), ('gnu gpl v3', 'GPL-3.0'),
  ('gplv3', 'GPL-3.0'), ('gpl 3 0', 'GPL-3.0'),
  ('gnu lesser general public license version 3', 'LGPL-3.0'), ('lgplv3', 'LGPL-3.0'),
  ('lgpl 3 0', 'LGPL-3.0'),
  ('gnu affero general public license version 3', 'AGPL-3.0'), ('agplv3', 'AGPL-3.0'),
  ('agpl 3 0', 'AGPL-3.0'),
  ('cc0 1 0', 'CC0-1.0'), ('creative commons zero v1 0 universal', 'CC0-1.0'),
  ('cc by 4 0', 'CC-BY-4.0'),
  ('creative commons attribution 4 0 international license', 'CC-BY-4.0'),
  ('cc by sa 4 0', 'CC-BY-SA-4.0'),
  ('creative commons attribution sharealike 4 0 international license', 'CC-BY-SA-4.0'),
  ('cc by nc 4 0', 'CC-BY-NC-4.0'),
  ('creative commons attribution noncommercial 4 0 international license', 'CC-BY-NC-4.0'),
  ('cc by nd 4 0', 'CC-BY-ND-4.0'),
  ('creative commons attribution noderivatives 4 0 international license', 'CC-BY-ND-4.0')),
known AS (
  SELECT opening || name || ending AS form, min(license_id) AS license_id
  FROM openings, names, (VALUES (''), (' the license')) AS v(ending) GROUP BY 1),
lowered AS (SELECT doc_id, lower(coalesce(text, '')) AS text FROM documents),
paragraphs AS (
  SELECT doc_id, text,
         list_filter(
           list_transform(
             string_split_regex(
               regexp_replace(text, '(?m)^[^\p{L}\p{N}\n]+$', '', 'g'), '\n{2,}'),
             lambda p: list_transform(string_split(trim(p, chr(10)), chr(10)), lambda l: struct_pack(
               l := l,
               notice := (regexp_matches(l,
                   '^[^\p{L}\p{N}©(]*(copyright|\(c\)|©)([ \t,:]*(copyright|\(c\)|©))*[ \t,:]*(19|20)[0-9]{2}')
                 AND len(regexp_extract_all(l, '[\p{L}\p{N}]+')) <= 20)
                 OR regexp_matches(l, '^[^\p{L}\p{N}]*all rights reserved[^\p{L}\p{N}]*$')))),
           lambda lines: list_contains(list_transform(lines, lambda x: x.notice), false)) AS parts
  FROM lowered),
bodies AS (
  SELECT doc_id, text,
         array_to_string(list_transform(
           list_concat(
             parts[1][list_position(list_transform(parts[1], lambda x: x.notice), false):],
             flatten(parts[2:])),
           lambda x: x.l), ' ') AS body
  FROM paragraphs),
forms AS (
  SELECT doc_id, f.line, f.form
  FROM bodies, unnest([
    struct_pack(line := false, form := trim(regexp_replace(body, '[^\p{L}\p{N}]+', ' ', 'g'))),
    struct_pack(line := true, form := regexp_replace(text, '[^\p{L}\p{N}\n]+', ' ', 'g'))]) AS u(f)),
spelled AS (
  SELECT doc_id, line,
         regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
         regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
         regexp_replace(form,
           'licenc(e|es|ed|ing|ee|or)\b', 'licens\1', 'g'),
           '\bsub licens', 'sublicens', 'g'),
           '\bnon (commercial|infring)', 'non\1', 'g'),
           '\b(author|organ|recogn|util|real|maxim|minim|optim|initial|emphas)is(e|ation|ing)',
           '\1iz\2', 'g'),
           '\b(fav|lab|behavi|hon)our', '\1or', 'g'),
           '\backnowledgement', 'acknowledgment', 'g'),
           '\b(judg)ement', '\1ment', 'g'),
           '\bfulfil\b', 'fulfill', 'g'),
           '\bwhilst\b', 'while', 'g'),
           '\bcopyright owner', 'copyright holder', 'g'),
           '\bhttps\b', 'http', 'g') AS form
  FROM forms),
named AS (
  SELECT s.doc_id, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notices
  FROM (SELECT doc_id, trim(unnest(string_split(form, chr(10)))) AS form FROM spelled WHERE line) AS s
  JOIN known k ON k.form = s.form GROUP BY s.doc_id)
SELECT s.doc_id, sha256(s.form) AS digest, k.license_id, n.notices
FROM spelled s LEFT JOIN known k ON k.form = s.form LEFT JOIN named n ON n.doc_id = s.doc_id
WHERE NOT s.line"""

# Every pair of a label is compared; the smallest id spreads along the links until none changes.
EMBEDDING_SQL = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM vectors a JOIN vectors b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_cosine_similarity(a.x, b.x) >= 0.98),
reached AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION
  SELECT r.vec_id, l.b FROM reached r JOIN links l ON r.other = l.a),
smallest AS (SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE a = e.vec_id) AS n_links, component_id,
       e.vec_id = component_id AS kept
FROM embeddings e JOIN smallest s ON e.vec_id = s.vec_id"""

# Sources in the order of cap over weight: the first that its share leaves below its cap sets the
# level for all after it. Documents lie in their source's line by the hash of their id.
MIXING_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (ARRAY[3.0, 1.0, 2.0]::DOUBLE[])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]
           AS weight
  FROM sized GROUP BY source),
capped AS (SELECT *, 2.0::DOUBLE * source_size AS cap FROM sources),
levels AS (
  SELECT *, cap / weight AS ratio,
         ((sum(source_size) OVER ()) * 1.5::DOUBLE - coalesce(sum(cap) OVER (
            ORDER BY cap / weight, source NULLS LAST
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
         / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
                             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM capped),
final AS (SELECT arg_min(level, ratio) AS level FROM levels WHERE cap > level * weight),
shares AS (
  SELECT source, source_size, weight,
         CASE WHEN f.level IS NULL THEN cap ELSE least(cap, weight * f.level) END AS target
  FROM levels CROSS JOIN final f),
lined AS (
  SELECT doc_id, source, size,
         coalesce(sum(size) OVER (
           PARTITION BY source
           ORDER BY substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15), doc_id, size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS line
  FROM sized),
placed AS (
  SELECT doc_id, l.source, size, line, source_size, target,
         CAST(floor(target + 1e-6) AS BIGINT) AS words
  FROM lined l JOIN shares s ON l.source IS NOT DISTINCT FROM s.source),
spans AS (
  SELECT *, high - words AS low
  FROM (SELECT source, CAST(floor(target + 1e-6) AS BIGINT) AS words,
               CAST(sum(CAST(floor(target + 1e-6) AS BIGINT)) OVER (ORDER BY source NULLS LAST)
                    AS BIGINT) AS high
        FROM shares)),
slots AS (
  SELECT total, bits, CAST(greatest(1, ceil(total / (1 << bits)::DOUBLE)) AS BIGINT) AS block
  FROM (SELECT coalesce(sum(words), 0) AS total,
               greatest(12, len(bin(greatest(coalesce(sum(words), 0), 1) // 512))
                            - CASE WHEN coalesce(sum(words), 0) < 512 THEN 1 ELSE 0 END) AS bits
        FROM spans)),
points AS (
  SELECT slot, list_sum(list_transform(range(bits), lambda k: ((slot >> k) & 1) << (bits - 1 - k)))
                 / (1 << bits)::DOUBLE * total AS point
  FROM slots, unnest(range(1 << bits)) AS u(slot)),
ranked AS (
  SELECT source, slot, row_number() OVER (PARTITION BY source ORDER BY slot) - 1 AS block
  FROM points JOIN spans ON point >= low AND point < high),
counts AS (SELECT source, count(*) AS n FROM ranked GROUP BY source)
SELECT doc_id, size, source_size, target,
       CAST(greatest(0, least(size, words - line))
            + greatest(0, least(size, words - source_size - line)) AS BIGINT) AS taken,
       CASE WHEN size > 0 AND line < words THEN
         coalesce(r.slot, CAST(line // s.block - coalesce(n, 0) + (1 << s.bits) AS BIGINT))
       END AS first_slot
FROM placed p CROSS JOIN slots s
LEFT JOIN ranked r ON r.source IS NOT DISTINCT FROM p.source AND r.block = line // s.block
LEFT JOIN counts c ON c.source IS NOT DISTINCT FROM p.source"""

# The length of a formatted turn: its text, a sign more per escaped character, and the marks.
CHAT_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -1, v.turn, v.role, '</s>[INST] ok [/INST]'
  FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(turn, role)),
placed AS (
  SELECT *, row_number() OVER w - 1 AS place, lag(role) OVER w AS previous,
         len(text) + len(regexp_extract_all(text, '[<\[\\]')) AS written,
         len(role) + len(regexp_extract_all(role, '[<\[\\]')) AS named
  FROM rows
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
checked AS (
  SELECT *, CASE WHEN coalesce(previous, 'none') || '>' || role IN (
                        'none>system', 'none>user', 'system>user', 'user>assistant',
                        'assistant>user') THEN NULL ELSE place END AS fault,
         written + CASE role WHEN 'system' THEN 18 WHEN 'user' THEN 18 WHEN 'assistant' THEN 11
                             ELSE named + 25 END AS marked
  FROM placed)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       CAST(coalesce(sum(len(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), ''))
         AS loss_sha256,
       CAST(sum(marked) AS BIGINT) AS formatted_chars, CAST(min(fault) AS INTEGER) AS first_fault
FROM checked GROUP BY conv_id"""

WARC_SQL = """
WITH payloads AS (
  SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
digests AS (
  SELECT page_id, octet_length(body) AS payload_bytes, sha256(body) AS payload_digest FROM payloads),
first AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS f FROM digests)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND f < page_id THEN 'revisit' ELSE 'response' END
         AS record_type,
       CASE WHEN payload_bytes >= 100 AND f < page_id THEN f END AS refers_to,
       CAST(NULL AS VARCHAR) AS error
FROM first"""

# Every phrase is counted; the lists are cut with offsets, so a long piece costs no more per word.
PHRASE_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
phrases AS (
  SELECT lang, 1 AS size, unnest(w) AS phrase FROM lists
  UNION ALL
  SELECT lang, 2, a || ' ' || b
  FROM (SELECT lang, unnest(w[1:-2]) AS a, unnest(w[2:]) AS b FROM lists WHERE len(w) > 1)
  UNION ALL
  SELECT lang, 3, a || ' ' || b || ' ' || c
  FROM (SELECT lang, unnest(w[1:-3]) AS a, unnest(w[2:-2]) AS b, unnest(w[3:]) AS c
        FROM lists WHERE len(w) > 2)),
counted AS MATERIALIZED (SELECT lang, size, phrase, count(*) AS f FROM phrases GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counted WHERE size = 1 GROUP BY lang),
candidates AS (
  SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w
  FROM counted WHERE size > 1 AND f >= 10),
cuts AS (
  SELECT *, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates)),
firsts AS MATERIALIZED (
  SELECT c.*, x.f AS l FROM cuts c JOIN counted x ON x.lang = c.lang AND x.phrase = c.first),
scored AS MATERIALIZED (
  SELECT c.*, y.f AS r, CAST((1000000::HUGEINT * a * a) // (l::HUGEINT * y.f) AS BIGINT) AS score
  FROM firsts c JOIN counted y ON y.lang = c.lang AND y.phrase = c.rest),
lowest AS (
  SELECT * FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
within AS (
  SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM candidates WHERE size = 3
  UNION ALL
  SELECT lang, array_to_string(w[2:3], ' '), a FROM candidates WHERE size = 3),
longest AS (SELECT lang, phrase, max(a) AS a FROM within GROUP BY lang, phrase),
ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, s.a DESC, s.phrase) AS rank
  FROM lowest s LEFT JOIN longest g ON s.size = 2 AND g.lang = s.lang AND g.phrase = s.phrase
  WHERE g.a IS NULL OR 100 * g.a < 50 * s.a)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""

# Nodes are named by a digest of their turns; every pair of a node and one below it is listed. The CRC
# is taken bit by bit.
TRIE_SQL = r"""
WITH ordered AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id
                            ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
openings AS (
  SELECT conv_id,
         xor(list_reduce(
           list_concat([4294967295::BIGINT], flatten(list_transform(
             string_split(CAST(conv_id AS VARCHAR), ''),
             lambda c: [CAST(unicode(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda crc, b: CASE WHEN b >= 0 THEN xor(crc, b)
                               ELSE xor(crc >> 1, 3988292384::BIGINT * (crc & 1)) END),
           4294967295::BIGINT) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM ordered) AS ids),
parts AS (
  SELECT c.conv_id, 0 AS part, place, role, text
  FROM openings c JOIN ordered o ON o.conv_id = c.conv_id - c.conv_id % 20 AND o.place <= c.h
  UNION ALL
  SELECT c.conv_id, 1, place, role, text
  FROM openings c JOIN ordered o ON o.conv_id = c.conv_id AND o.place > c.h),
turns AS (
  SELECT conv_id, row_number() OVER w AS depth,
         len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
         sha256(string_agg(sha256(len(role) || ':' || role || text), '') OVER w) AS node
  FROM parts
  WINDOW w AS (PARTITION BY conv_id ORDER BY part, place
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
members AS (
  SELECT conv_id, 0 AS depth, 0 AS words, 'root' AS node FROM openings
  UNION ALL SELECT * FROM turns),
placed AS (
  SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS parent,
         lead(node) OVER (PARTITION BY conv_id ORDER BY depth) IS NULL AS ends
  FROM members),
nodes AS (
  SELECT node, min(conv_id) AS conv_id, any_value(depth) AS depth, any_value(parent) AS parent,
         count(*) AS n_convs, (count(*) - 1) * any_value(words) AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
                         FILTER (WHERE ends), '')) AS ends_sha256
  FROM placed GROUP BY node),
children AS (SELECT parent, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
pairs AS (
  SELECT DISTINCT a.node AS top, b.node
  FROM members a JOIN members b ON a.conv_id = b.conv_id AND a.depth <= b.depth),
sums AS (
  SELECT top, sum(saved) AS saved, count(*) FILTER (WHERE c.n IS NULL) AS leaves
  FROM pairs JOIN nodes USING (node) LEFT JOIN children c ON c.parent = pairs.node
  GROUP BY top)
SELECT t.conv_id, t.depth, p.conv_id AS parent_conv_id, t.n_convs,
       coalesce(c.n, 0) AS n_children, s.leaves AS n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, t.ends_sha256
FROM nodes t JOIN sums s ON s.top = t.node
LEFT JOIN nodes p ON p.node = t.parent LEFT JOIN children c ON c.parent = t.node"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_license_scan": license_scan,
        "op2_embedding_near_dedup": embedding_near_dedup,
        "op3_html_extraction": html_extraction,
        "op4_source_mixing": source_mixing,
        "op5_nearest_neighbours": nearest_neighbours,
        "op6_chat_formatting": chat_formatting,
        "op7_quality_classifier": quality_classifier,
        "op8_mixture_packing": mixture_packing,
        "op9_minhash_near_dedup": minhash_dedup,
        "op10_warc_round_trip": warc_round_trip,
        "op11_phrase_collocations": phrase_collocations,
        "op12_conversation_trie": conversation_prefix_trie,
        "op13_token_counts": document_token_counts,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_license_scan": LICENSE_SQL,
        "op2_embedding_near_dedup": EMBEDDING_SQL,
        "op4_source_mixing": MIXING_SQL,
        "op6_chat_formatting": CHAT_SQL,
        "op10_warc_round_trip": WARC_SQL,
        "op11_phrase_collocations": PHRASE_SQL,
        "op12_conversation_trie": TRIE_SQL,
    }
