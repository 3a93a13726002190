"""The registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_path
from . import (
    byte_bpe, chat_rotation, importance, language_id, line_runs, ngram_join, packing, pivot_dedup, prefix_trie, quality, rule_ledger,
    substring_dedup, token_files,
)
from .common import table


def op1_pivot_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links all vectors of a cosine of 0.95 or more."""
    return pivot_dedup.link_vectors(table(spark, sf_dir, "embeddings"))


def op2_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures all documents, evaluates every rule once and applies the current policy."""
    return rule_ledger.apply_policy(rule_ledger.ledger(table(spark, sf_dir, "documents")))


def op3_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deletes later copies of repeated runs of lines from all documents."""
    return line_runs.delete_copies(table(spark, sf_dir, "documents").select("doc_id", "text"), counts=True)


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Joins all documents whose sets of 3-word shingles have a Jaccard similarity of 0.9 or more."""
    return ngram_join.jaccard_join(table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicts the language of all documents with a network that never saw one fold."""
    return language_id.identify(table(spark, sf_dir, "documents"))


def op6_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Renders all conversations from every participant's point of view; mask spans as text."""
    found = chat_rotation.rotate(table(spark, sf_dir, "conversations"))
    spans = F.transform("mask", lambda m: F.concat_ws("-", m["start"].cast("string"), m["end"].cast("string")))
    return found.withColumn("mask", F.array_join(spans, ","))


def op7_ffd_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packs all documents into sequences of at most 4096 ids; digests of the packed ids."""
    packed = packing.pack_documents(table(spark, sf_dir, "documents"))
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op8_quality_qda(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores all documents with a discriminant learned from the labels outside one fold."""
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all documents as compressed token files and reads the files back."""
    folder = new_path(spark, "tokens")
    token_files.write_token_files(table(spark, sf_dir, "documents"), folder)
    return token_files.read_token_files(spark, folder, digest=True)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes all documents and decodes the ids."""
    return byte_bpe.round_trip_digests(table(spark, sf_dir, "documents"))


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Takes from all documents the passages of 13 words and more that an earlier one holds; digests of what stays."""
    found = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all rebuilt conversations; digests of the ids that end at each node."""
    return prefix_trie.trie_digests(table(spark, sf_dir, "conversations"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighs all documents by their likeness to the benchmark and draws a tenth of them."""
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_ALL = (
    op1_pivot_dedup, op2_rule_ledger, op3_line_runs, op4_ngram_join, op5_language_id, op6_chat_rotation, op7_ffd_packing, op8_quality_qda,
    op9_token_files, op10_byte_bpe, op11_substring_dedup, op12_prefix_trie, op13_importance_resampling,
)
QUERIES = {f.__name__: f for f in _ALL}

_RULE_BITS = " + ".join(f"CASE WHEN {test} THEN {1 << bit} ELSE 0 END" for bit, (_, test) in enumerate(rule_ledger.RULES))

_WORD = r"[^\x20\x09-\x0D]+"
_LONGEST = line_runs.MIN_WORDS

# The shortest run with enough words from a line on, and up to a line: its length in lines.
_RUN_LENGTH = {
    move: "CASE "
    + " ".join(
        f"WHEN {' + '.join(['words', *(f'{move}(words, {k}) OVER by_line' for k in range(1, m))])} >= {line_runs.MIN_WORDS} THEN {m}"
        for m in range(1, _LONGEST + 1)
    )
    + " END"
    for move in ("lead", "lag")
}

# The smallest id that links lead to, from a table of pairs in both directions.
_REACH = """
    reach AS (
        SELECT id, id AS other FROM nodes
        UNION
        SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other
    ),
    found AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
"""

# CRC-32 from its polynomial: a table of 256 remainders, and the remainder of a text byte by byte.
_CRC_TABLE = """
    crc_table AS (
        SELECT list(v ORDER BY i) AS remainders FROM (
            SELECT i, list_reduce(range(8), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i) AS v
            FROM range(256) r(i))
    )
"""


def _crc32(text: str) -> str:
    codes = f"list_transform(range(octet_length(encode({text}))), lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)"
    step = "lambda a, b: xor(a >> 8, remainders[(xor(a, b) & 255) + 1])"
    return f"xor(list_reduce({codes}, {step}, 4294967295), 4294967295)"


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

SQL: dict[str, str] = {
    "op1_pivot_dedup": f"""
        WITH RECURSIVE
        nodes AS (SELECT DISTINCT vec_id AS id FROM embeddings WHERE vec_id IS NOT NULL),
        usable AS (
            SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ),
        links AS (
            SELECT a.id AS a, b.id AS b FROM usable a JOIN usable b
            ON a.id <> b.id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= {pivot_dedup.COSINE}
        ),
        {_REACH},
        counts AS (SELECT a AS id, count(*) AS n_links FROM links GROUP BY a)
        SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM embeddings JOIN found f ON f.id = vec_id LEFT JOIN counts c ON c.id = vec_id
    """,
    "op3_line_runs": f"""
        WITH split AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
        lines AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS place FROM split),
        worded AS (
            SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY place) AS i,
                   len(regexp_extract_all(line, '{_WORD}')) AS words
            FROM lines WHERE regexp_matches(line, '{_WORD}')
        ),
        lengths AS (
            SELECT doc_id, i, {_RUN_LENGTH["lead"]} AS ahead, {_RUN_LENGTH["lag"]} AS back
            FROM worded WINDOW by_line AS (PARTITION BY doc_id ORDER BY i)
        ),
        runs AS (
            SELECT doc_id, i AS start, ahead AS length FROM lengths WHERE ahead IS NOT NULL
            UNION
            SELECT doc_id, i - back + 1, back FROM lengths WHERE back IS NOT NULL
        ),
        contents AS (
            SELECT r.doc_id, r.start, r.length, string_agg(w.line, chr(10) ORDER BY w.i) AS content
            FROM runs r JOIN worded w ON w.doc_id = r.doc_id AND w.i BETWEEN r.start AND r.start + r.length - 1
            GROUP BY r.doc_id, r.start, r.length
        ),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY length, content ORDER BY doc_id, start) AS n FROM contents),
        gone AS (
            SELECT DISTINCT w.doc_id, w.place, w.i FROM ranked r
            JOIN worded w ON w.doc_id = r.doc_id AND w.i BETWEEN r.start AND r.start + r.length - 1
            WHERE n > 1
        ),
        stretches AS (
            SELECT doc_id, max(n) AS longest_run, sum(n)::BIGINT AS n_deleted FROM (
                SELECT doc_id, count(*) AS n FROM (
                    SELECT doc_id, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS stretch FROM gone)
                GROUP BY doc_id, stretch)
            GROUP BY doc_id
        ),
        kept AS (
            SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.place) AS text
            FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.place = l.place WHERE g.place IS NULL GROUP BY l.doc_id
        ),
        counts AS (SELECT doc_id, count(*) AS n_lines FROM worded GROUP BY doc_id)
        SELECT s.doc_id, CASE WHEN s.text IS NOT NULL THEN coalesce(k.text, '') END AS text,
               coalesce(n_lines, 0) AS n_lines, coalesce(n_deleted, 0) AS n_deleted, coalesce(longest_run, 0) AS longest_run
        FROM split s LEFT JOIN kept k USING (doc_id) LEFT JOIN counts c USING (doc_id) LEFT JOIN stretches x USING (doc_id)
    """,
    "op4_ngram_join": f"""
        WITH RECURSIVE
        nodes AS (SELECT DISTINCT doc_id AS id FROM documents),
        words AS (
            SELECT doc_id AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '{_WORD}') AS w
            FROM documents WHERE text IS NOT NULL
        ),
        shingles AS (
            SELECT DISTINCT id, shingle FROM (
                SELECT id, unnest(CASE WHEN len(w) < {ngram_join.SIZE} THEN [array_to_string(w, ' ')] ELSE
                    list_transform(range(1, len(w) - {ngram_join.SIZE} + 2), lambda i: array_to_string(w[i : i + {ngram_join.SIZE} - 1], ' ')) END) AS shingle
                FROM words WHERE len(w) > 0)
        ),
        sizes AS (SELECT id, count(*) AS n FROM shingles GROUP BY id),
        shared AS (
            SELECT a.id AS a, b.id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.id <> b.id
            GROUP BY a.id, b.id
        ),
        links AS (
            SELECT a, b FROM shared s JOIN sizes x ON x.id = s.a JOIN sizes y ON y.id = s.b
            WHERE {ngram_join.DEN} * s.n >= {ngram_join.NUM} * (x.n + y.n - s.n)
        ),
        {_REACH},
        counts AS (SELECT a AS id, count(*) AS n_links FROM links GROUP BY a)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, coalesce(n_links, 0) AS n_links
        FROM documents JOIN found f ON f.id = doc_id LEFT JOIN sizes s ON s.id = doc_id LEFT JOIN counts c ON c.id = doc_id
    """,
    "op6_chat_rotation": rf"""
        WITH turns AS (
            SELECT conv_id, turn, CASE WHEN trim(role) <> '' THEN role END AS role,
                   replace(coalesce(text, ''), '<|', '< |') AS text
            FROM conversations WHERE conv_id IS NOT NULL
        ),
        numbered AS (
            SELECT *, row_number() OVER (
                PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text) - 1 AS place
            FROM turns
        ),
        people AS (SELECT DISTINCT conv_id, role AS participant FROM turns WHERE role <> '{chat_rotation.SYSTEM}'),
        seen AS (
            SELECT conv_id, participant, place // {chat_rotation.PART_TURNS} AS part, place, text,
                   coalesce(role = participant, false) AS own,
                   '{chat_rotation.START}' || CASE
                       WHEN role = '{chat_rotation.SYSTEM}' THEN 'system'
                       WHEN role = participant THEN 'assistant'
                       WHEN role IS NULL THEN 'user'
                       ELSE 'user name=' || regexp_replace(role, '[\x00-\x20<|>]+', '_', 'g') END || chr(10) AS header
            FROM numbered JOIN people USING (conv_id)
        ),
        pieces AS (
            SELECT *, header || text || '{chat_rotation.END}' || chr(10) AS piece,
                   coalesce(sum(length(header) + length(text) + {len(chat_rotation.END) + 1}) OVER (
                       PARTITION BY conv_id, participant, part ORDER BY place
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT + length(header) AS start
            FROM seen
        )
        SELECT conv_id, participant, part::BIGINT AS part, count(*) AS n_turns,
               count(*) FILTER (own) AS n_own, string_agg(piece, '' ORDER BY place) AS rendered,
               coalesce(string_agg(start || '-' || (start + length(text) + {len(chat_rotation.END)}), ',' ORDER BY place)
                   FILTER (own), '') AS mask
        FROM pieces GROUP BY conv_id, participant, part
    """,
    "op2_rule_ledger": rf"""
        WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
        split_words AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM texts),
        words AS (
            SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM split_words
        ),
        windows AS (
            SELECT r, i, word, lead(word, 1) OVER w AS w1, lead(word, 2) OVER w AS w2,
                   lead(word, 3) OVER w AS w3, lead(word, 4) OVER w AS w4
            FROM words WINDOW w AS (PARTITION BY r ORDER BY i)
        ),
        seen AS (
            SELECT r, i, count(*) OVER (PARTITION BY r, word, w1, w2, w3, w4) AS n FROM windows WHERE w4 IS NOT NULL
        ),
        covered AS (
            SELECT r, count(DISTINCT i + k) AS n_repeat_words
            FROM (SELECT r, i FROM seen WHERE n > 1), (SELECT unnest(range(0, 5)) AS k)
            GROUP BY r
        ),
        lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM texts),
        line_counts AS (
            SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
            FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
        ),
        word_counts AS (SELECT r, count(*) AS n_words, sum(length(word)) AS word_chars FROM words GROUP BY r),
        measured AS (
            SELECT t.doc_id, coalesce(w.n_words, 0) AS n_words, coalesce(w.word_chars, 0)::BIGINT AS word_chars,
                   length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                   coalesce(l.n_lines, 0) AS n_lines, coalesce(l.n_dup_lines, 0) AS n_dup_lines,
                   coalesce(c.n_repeat_words, 0) AS n_repeat_words
            FROM texts t LEFT JOIN word_counts w USING (r) LEFT JOIN line_counts l USING (r) LEFT JOIN covered c USING (r)
        ),
        entries AS (SELECT *, CAST({_RULE_BITS} AS BIGINT) AS failed FROM measured)
        SELECT *, failed & {rule_ledger.mask(rule_ledger.BASE)} <> 0 AS base_failed,
               failed & {rule_ledger.mask(rule_ledger.BASE) | rule_ledger.mask(rule_ledger.CURRENT)} = 0 AS kept
        FROM entries
    """,
    "op11_substring_dedup": f"""
        WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
        windows AS (
            SELECT doc_id, i, array_to_string(w[i : i + {substring_dedup.WINDOW - 1}], ' ') AS words
            FROM texts, unnest(range(1, len(w) - {substring_dedup.WINDOW - 2})) t(i)
        ),
        firsts AS (SELECT words, min(doc_id) AS first FROM windows GROUP BY words),
        gone AS (
            SELECT DISTINCT doc_id, i + k AS i FROM windows JOIN firsts USING (words), range({substring_dedup.WINDOW}) r(k)
            WHERE doc_id > first
        ),
        words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM texts),
        kept AS (
            SELECT doc_id, count(g.i) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (g.i IS NULL) AS kept
            FROM words LEFT JOIN gone g USING (doc_id, i) GROUP BY doc_id
        )
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM texts LEFT JOIN kept USING (doc_id)
    """,
    "op12_prefix_trie": f"""
        WITH {_CRC_TABLE},
        turns AS (
            SELECT conv_id, turn, coalesce(text, '') AS text,
                   md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
            FROM conversations WHERE conv_id IS NOT NULL
        ),
        convs AS (
            SELECT conv_id, list({{'digest': digest, 'bytes': octet_length(encode(text))}} ORDER BY turn NULLS FIRST, digest) AS turns
            FROM turns GROUP BY conv_id
        ),
        hashed AS (
            SELECT conv_id, turns, {_crc32("conv_id::VARCHAR")} % {prefix_trie.SHARED} AS h FROM convs, crc_table
        ),
        rebuilt AS (
            SELECT a.conv_id, list_concat(coalesce(b.turns, [])[: a.h], a.turns[a.h + 1 :]) AS turns
            FROM hashed a LEFT JOIN convs b ON b.conv_id = a.conv_id - a.conv_id % {prefix_trie.GROUP}
        ),
        prefixes AS (
            SELECT conv_id, d AS depth, len(turns) AS n, coalesce(turns[d].bytes, 0) AS bytes,
                   array_to_string(list_transform(turns[: d], lambda t: t.digest), '') AS prefix
            FROM rebuilt, unnest(range(0, len(turns) + 1)) r(d)
        ),
        nodes AS (
            SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
                   string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth) AS ends
            FROM prefixes GROUP BY prefix, depth
        ),
        children AS (SELECT left(prefix, 32 * (depth - 1)) AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
        whole AS (SELECT *, coalesce(n_children, 0) AS kids FROM nodes LEFT JOIN children USING (prefix)),
        sums AS (
            SELECT left(prefix, 32 * a) AS prefix, count(*) FILTER (kids = 0) AS n_leaves, sum((n_convs - 1) * bytes)::BIGINT AS saved_tokens
            FROM whole, unnest(range(0, depth + 1)) r(a) GROUP BY 1
        )
        SELECT w.conv_id, w.depth, p.conv_id AS parent_conv_id, w.n_convs, w.kids AS n_children, n_leaves, saved_tokens,
               sha256(coalesce(w.ends, '')) AS ends_sha256
        FROM whole w JOIN sums USING (prefix) LEFT JOIN nodes p ON p.depth = w.depth - 1 AND p.prefix = left(w.prefix, 32 * p.depth)
    """,
    "op13_importance_resampling": f"""
        WITH {_CRC_TABLE},
        found AS (
            SELECT doc_id, true AS ours, unnest(regexp_extract_all({_LOWER}, '{_ALNUM}')) AS word FROM documents WHERE text IS NOT NULL
            UNION ALL
            SELECT item_id, false, unnest(regexp_extract_all({_LOWER}, '{_ALNUM}')) FROM benchmark WHERE text IS NOT NULL
        ),
        buckets AS (SELECT word, {_crc32("word")} % {importance.BUCKETS} AS bucket FROM (SELECT DISTINCT word FROM found), crc_table),
        counts AS (
            SELECT bucket, count(*) FILTER (ours) AS s, count(*) FILTER (NOT ours) AS t FROM found JOIN buckets USING (word) GROUP BY bucket
        ),
        sums AS (SELECT sum(s) AS big_s, sum(t) AS big_t FROM counts),
        gains AS (
            SELECT bucket, floor(1000 * ln(((t + 1) * (big_s + {importance.BUCKETS}))::DOUBLE / ((s + 1) * (big_t + {importance.BUCKETS}))::DOUBLE))::BIGINT AS gain
            FROM counts, sums
        ),
        weighed AS (
            SELECT doc_id, count(*) AS n_features, sum(gain)::BIGINT AS gain
            FROM found JOIN buckets USING (word) JOIN gains USING (bucket) WHERE ours GROUP BY doc_id
        ),
        scored AS (
            SELECT doc_id, coalesce(n_features, 0) AS n_features,
                   coalesce((gain - ((gain % n_features) + n_features) % n_features) // n_features, 0) AS weight,
                   floor(-1000 * ln(-ln((('0x' || left(sha256('{importance.SEED}:' || doc_id), 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS noise
            FROM documents LEFT JOIN weighed USING (doc_id)
        ),
        drawn AS (
            SELECT doc_id, row_number() OVER (ORDER BY weight + noise DESC, doc_id) AS rank,
                   count(*) OVER () * {importance.PERCENT} // 100 AS n
            FROM scored WHERE n_features >= {importance.MIN_WORDS}
        )
        SELECT s.doc_id, n_features, weight, weight + noise AS score, CASE WHEN rank <= n THEN rank END AS rank
        FROM scored s LEFT JOIN drawn d ON d.doc_id = s.doc_id
    """,
}
