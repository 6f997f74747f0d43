"""One query per operator over the whole tables, and the SQL it must agree with where SQL can tell."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    bpe,
    collocations,
    conversations,
    dac,
    decontaminate,
    exact_dedup,
    fm_index,
    language,
    pii,
    simhash,
    suffix_array,
    toxicity,
    transducer,
)
from .common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(f: Query) -> Query:
        QUERIES[name] = f
        if oracle is not None:
            ORACLES[name] = oracle
        return f

    return register


@query(
    "op10_exact_dedup",
    r"""
    WITH t AS (
      SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
      FROM documents
    )
    SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = min(doc_id) OVER g AS kept, text_sha256
    FROM t WINDOW g AS (PARTITION BY text_sha256)
    """,
)
def op10_exact_dedup(spark, d):
    return exact_dedup.exact_duplicates(table(spark, d, "documents"))


@query("op6_bpe_encode_decode")
def op6_bpe_encode_decode(spark, d):
    return bpe.round_trip(table(spark, d, "documents"))


@query("op5_token_ids")
def op5_token_ids(spark, d):
    return dac.written_and_read(table(spark, d, "documents"))


@query(
    "op2_suffix_array_dedup",
    """
    WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
    starts AS (
      SELECT doc_id, p, md5(array_slice(b, p, p + 199)) AS h
      FROM (SELECT doc_id, b, unnest(range(1, octet_length(b) - 198)) AS p FROM d)
    ),
    repeated AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY h) AS c FROM starts) WHERE c > 1),
    -- runs of repeated starts whose bytes touch
    runs AS (
      SELECT doc_id, min(p) AS a, max(p) + 199 AS z
      FROM (
        SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run
        FROM (
          SELECT doc_id, p,
                 CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 200 THEN 0 ELSE 1 END AS fresh
          FROM repeated
        )
      )
      GROUP BY doc_id, run
    ),
    kept AS (
      SELECT doc_id, a, lag(z, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) + 1 AS from_byte, a - 1 AS to_byte FROM runs
      UNION ALL
      SELECT doc_id, octet_length(any_value(b)) + 1, max(z) + 1, octet_length(any_value(b))
      FROM runs JOIN d USING (doc_id) GROUP BY doc_id
    ),
    cut AS (
      SELECT doc_id,
             string_agg(CASE WHEN from_byte <= to_byte THEN hex(array_slice(b, from_byte, to_byte)) ELSE '' END, '' ORDER BY a) AS x
      FROM kept JOIN d USING (doc_id) GROUP BY doc_id
    ),
    gone AS (SELECT doc_id, sum(z - a + 1) AS n, count(*) AS k FROM runs GROUP BY doc_id)
    SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
           CAST(coalesce(k, 0) AS BIGINT) AS n_spans, sha256(coalesce(unhex(x), b)) AS kept_sha256
    FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN cut USING (doc_id)
    """,
)
def op2_suffix_array_dedup(spark, d):
    return suffix_array.remove_repeated_bytes(table(spark, d, "documents")).drop("kept")


@query(
    "op9_substring_dedup",
    r"""
    WITH d AS (
      SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
      FROM documents
    ),
    starts AS (
      SELECT doc_id, p, md5(array_to_string(words[p:p + 34], ' ')) AS h
      FROM (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS p FROM d)
    ),
    repeated AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY h) AS c FROM starts) WHERE c > 1),
    gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 35)) AS i FROM repeated),
    placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM d),
    kept AS (
      SELECT doc_id, count(gone.i) AS n_removed,
             coalesce(string_agg(word, ' ' ORDER BY i) FILTER (gone.i IS NULL), '') AS text
      FROM placed LEFT JOIN gone USING (doc_id, i) GROUP BY doc_id
    )
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
           sha256(coalesce(text, '')) AS kept_sha256
    FROM d LEFT JOIN kept USING (doc_id)
    """,
)
def op9_substring_dedup(spark, d):
    return fm_index.remove_repeated_words(table(spark, d, "documents")).drop("kept")


@query("op8_simhash_near_dedup")
def op8_simhash_near_dedup(spark, d):
    return simhash.near_duplicates(table(spark, d, "documents")).drop("doc_key")


_WORDS = r"""list_filter(
        string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""


@query(
    "op7_decontamination",
    f"""
    WITH d AS (SELECT doc_id, {_WORDS} AS words FROM documents),
    b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS words FROM benchmark),
    windows AS (
      SELECT DISTINCT item, n, array_to_string(words[p:p + n - 1], ' ') AS w
      FROM (
        SELECT item, words, least(13, len(words)) AS n, unnest(range(1, len(words) - least(13, len(words)) + 2)) AS p
        FROM b WHERE len(words) > 0
      )
    ),
    starts AS (
      SELECT doc_id, p, n, array_to_string(words[p:p + n - 1], ' ') AS w
      FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM windows))
    ),
    hits AS (SELECT doc_id, p, n, item FROM starts JOIN windows USING (n, w)),
    covered AS (
      SELECT doc_id, count(DISTINCT i) AS n_hit
      FROM (SELECT doc_id, unnest(range(p, p + n)) AS i FROM hits) GROUP BY doc_id
    ),
    found AS (
      SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
    )
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
    FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
    """,
)
def op7_decontamination(spark, d):
    return decontaminate.overlap_digests(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query("op3_toxicity")
def op3_toxicity(spark, d):
    return toxicity.toxicity(table(spark, d, "documents"), table(spark, d, "labels"))


@query("op4_language_id")
def op4_language_id(spark, d):
    return language.languages(table(spark, d, "documents"))


@query("op1_personal_data")
def op1_personal_data(spark, d):
    return pii.personal_data(table(spark, d, "documents"))


@query(
    "op11_phrase_collocations",
    r"""
    WITH texts AS (
      SELECT coalesce(lang, 'und') AS lang,
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
      FROM documents
    ),
    pieces AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts),
    listed AS (SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS words FROM pieces),
    totals AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM listed GROUP BY lang),
    placed AS (
      SELECT lang, words, unnest(range(1, len(words) + 1)) AS p FROM listed WHERE len(words) > 0
    ),
    counts AS (
      SELECT lang, size, array_to_string(words[p:p + size - 1], ' ') AS phrase, count(*) AS f
      FROM placed, (SELECT unnest(range(1, 5)) AS size)
      WHERE p + size - 1 <= len(words)
      GROUP BY ALL HAVING count(*) >= 30
    ),
    split AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE size > 1),
    cuts AS (
      SELECT s.lang, s.size, s.phrase, s.a, k, x.f AS l, y.f AS r,
             (CAST(s.a AS HUGEINT) * 2000000) // (x.f + y.f) AS score
      FROM (SELECT *, unnest(range(1, size)) AS k FROM split) s
      JOIN counts x ON x.lang = s.lang AND x.phrase = array_to_string(w[1:k], ' ')
      JOIN counts y ON y.lang = s.lang AND y.phrase = array_to_string(w[k + 1:], ' ')
    ),
    scored AS (
      SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
    ),
    inner_phrases AS (
      SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS most
      FROM split, (SELECT unnest(range(1, 4)) AS i), (SELECT unnest(range(2, 4)) AS m)
      WHERE m < size AND i + m - 1 <= size
      GROUP BY ALL
    ),
    free AS (
      SELECT scored.* FROM scored LEFT JOIN inner_phrases USING (lang, phrase)
      WHERE most IS NULL OR 100 * CAST(most AS HUGEINT) < 80 * CAST(a AS HUGEINT)
    ),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM free
    )
    SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
    """,
)
def op11_phrase_collocations(spark, d):
    return collocations.collocations(table(spark, d, "documents"))


@query("op12_conversation_repair")
def op12_conversation_repair(spark, d):
    return conversations.damage_and_repair(table(spark, d, "conversations"))


@query("op13_byte_bpe_transducer")
def op13_byte_bpe_transducer(spark, d):
    return transducer.round_trip(table(spark, d, "documents"))
