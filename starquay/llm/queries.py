"""The operators as queries over the given tables, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starquay.llm.backoff_scores import backoff_scores
from starquay.llm.collocations import collocations
from starquay.llm.decontaminate import contaminated
from starquay.llm.fuzzy_passages import shared_passages
from starquay.llm.html_text import extract_text
from starquay.llm.importance_draw import draw
from starquay.llm.jaccard_join import jaccard_components
from starquay.llm.language_mixture import identify_languages
from starquay.llm.line_quality import score_quality
from starquay.llm.nearest import nearest
from starquay.llm.personal_data import find_personal_data
from starquay.llm.pfair_mix import mix_sources
from starquay.llm.secret_scan import find_secrets

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def _query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


# Words of every text in SQL: A-Z folded, runs of anything but the six space characters.
_WORDS_SQL = r"""
words AS (SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents)"""

ORACLE["op9_jaccard_join"] = f"""
WITH RECURSIVE {_WORDS_SQL},
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
    END AS s FROM words),
entries AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (SELECT a.doc_id AS x, b.doc_id AS y FROM entries a JOIN entries b
    ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached AS (SELECT x AS doc_id, x AS r FROM ways UNION SELECT reached.doc_id, ways.y FROM reached JOIN ways ON ways.x = r),
classes AS (SELECT doc_id, min(r) AS component_id FROM reached GROUP BY doc_id)
SELECT sets.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(component_id, sets.doc_id) AS component_id
FROM sets LEFT JOIN classes ON sets.doc_id = classes.doc_id"""

ORACLE["op6_backoff_scores"] = f"""
WITH {_WORDS_SQL},
steps AS (SELECT doc_id, unnest(list_prepend('<START>', w)) AS v, unnest(list_append(w, '<STOP>')) AS u
    FROM words WHERE len(w) > 0),
own AS (SELECT doc_id, v, u, count(*) AS n FROM steps GROUP BY doc_id, v, u),
own_first AS (SELECT doc_id, v, sum(n) AS n FROM own GROUP BY doc_id, v),
pairs AS (SELECT v, u, sum(n) AS n FROM own GROUP BY v, u),
firsts AS (SELECT v, sum(n) AS n FROM own_first GROUP BY v),
total AS (SELECT sum(n) AS n FROM firsts WHERE v <> '<START>'),
scored AS (SELECT own.doc_id, own.n AS n, pairs.n - own.n AS others,
    CASE WHEN pairs.n > own.n THEN ln((pairs.n - own.n) / (f.n - o.n)) ELSE ln(0.4 * g.n / total.n) END AS s
    FROM own JOIN pairs ON own.v = pairs.v AND own.u = pairs.u JOIN firsts f ON own.v = f.v
    JOIN own_first o ON own.doc_id = o.doc_id AND own.v = o.v JOIN firsts g ON own.u = g.v, total
    WHERE own.u <> '<STOP>'),
sums AS (SELECT doc_id, sum(n) AS n_words, sum(CASE WHEN others > 0 THEN n ELSE 0 END) AS n_seen, sum(n * s) AS score
    FROM scored GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(n_seen, 0) AS BIGINT) AS n_seen,
    CAST(coalesce(n_words - n_seen, 0) AS BIGINT) AS n_backed_off, round(coalesce(score, 0.0), 3) AS log_score,
    round(score / n_words, 6) AS mean_log_score
FROM documents d LEFT JOIN sums ON d.doc_id = sums.doc_id"""


ORACLE["op11_collocations"] = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM documents),
grams AS (SELECT lang, s AS size, unnest(list_transform(range(1, len(w) - s + 2), lambda i: array_to_string(w[i:i + s - 1], ' '))) AS phrase
    FROM pieces, (VALUES (1), (2), (3)) AS sizes(s)),
counts AS (SELECT lang, size, phrase, count(*) AS n FROM grams GROUP BY lang, size, phrase),
totals AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM counts WHERE size = 1 GROUP BY lang),
candidates AS (SELECT lang, size, phrase, n AS a, string_split(phrase, ' ') AS w FROM counts WHERE size > 1 AND n >= 10),
cuts AS (SELECT lang, size, phrase, a, k, array_to_string(w[1:k], ' ') AS lp, array_to_string(w[k + 1:size], ' ') AS rp
    FROM candidates, (VALUES (1), (2)) AS places(k) WHERE k < size),
scored AS (SELECT c.lang, c.phrase, c.a, k, x.n AS l, y.n AS r,
    (CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST(x.n AS HUGEINT) * y.n) AS score
    FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = lp JOIN counts y ON y.lang = c.lang AND y.phrase = rp),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
held AS (SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, a, array_to_string(w[1:2], ' ') AS phrase FROM candidates WHERE size = 3
    UNION ALL SELECT lang, a, array_to_string(w[2:3], ' ') FROM candidates WHERE size = 3) GROUP BY lang, phrase),
kept AS (SELECT b.* FROM best b LEFT JOIN held h ON h.lang = b.lang AND h.phrase = b.phrase
    WHERE h.longer IS NULL OR 100 * h.longer < 50 * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT r.lang, rank, phrase, a, l, r, t.n AS n, CAST(score AS BIGINT) AS score
FROM ranked r JOIN totals t ON t.lang = r.lang WHERE rank <= 2000"""

# A CRC has no function in SQL: its table comes from the polynomial, its bytes from hex digits.
ORACLE["op12_importance_draw"] = r"""
WITH crc_table AS (SELECT list(list_reduce(range(0, 9), lambda c, k: CASE WHEN k = 0 THEN c
    WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS crc FROM range(256) AS bytes(b)),
texts AS (SELECT 'd' AS side, doc_id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
words AS (SELECT side, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
entries AS (SELECT side, doc_id, f, count(*) AS n FROM (SELECT side, doc_id, unnest(w) AS f FROM words) GROUP BY ALL),
bytes AS (SELECT f, list_transform(range(0, len(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)) AS b
    FROM (SELECT DISTINCT f, hex(encode(f)) AS h FROM entries)),
hashed AS (SELECT f, xor(list_reduce(b, lambda c, x: xor(crc[(xor(c, x) & 255) + 1], c >> 8), 4294967295), 4294967295) % 10000 AS bucket
    FROM bytes, crc_table),
sums AS (SELECT bucket, sum(n) FILTER (side = 'd') AS s, sum(n) FILTER (side = 'b') AS t
    FROM entries JOIN hashed USING (f) GROUP BY bucket),
totals AS (SELECT coalesce(sum(s), 0) AS S0, coalesce(sum(t), 0) AS T0 FROM sums),
gains AS (SELECT bucket, floor(1000.0::DOUBLE * ln((CAST(coalesce(t, 0) + 1 AS DOUBLE) * CAST(S0 + 10000 AS DOUBLE))
    / (CAST(coalesce(s, 0) + 1 AS DOUBLE) * CAST(T0 + 10000 AS DOUBLE)))) AS gain FROM sums, totals),
weights AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS weight
    FROM entries JOIN hashed USING (f) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY doc_id),
scored AS (SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000.0::DOUBLE * ln(-ln((CAST('0x' || substr(sha256('2024:' || d.doc_id), 1, 8) AS BIGINT)
        + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
    FROM documents d LEFT JOIN weights USING (doc_id)),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank,
    count(*) OVER () * 10 // 100 AS drawn FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, rank FROM scored LEFT JOIN (SELECT * FROM ranked WHERE rank <= drawn) USING (doc_id)"""


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query
def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(_table(spark, sf_dir, "pages"))


@_query
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(_table(spark, sf_dir, "documents"))


@_query
def op4_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(_table(spark, sf_dir, "documents"))


@_query
def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents").select("doc_id", "source"))


@_query
def op6_backoff_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = backoff_scores(_table(spark, sf_dir, "documents"))
    # Sums of doubles depend on their order in the last digits.
    rounded = {"log_score": F.round("log_score", 3), "mean_log_score": F.round("mean_log_score", 6)}
    return scores.withColumns(rounded)


@_query
def op7_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query
def op8_fuzzy_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_passages(_table(spark, sf_dir, "documents"))


@_query
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents"))


@_query
def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_table(spark, sf_dir, "embeddings"))


@_query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"))


@_query
def op12_importance_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return draw(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query
def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(_table(spark, sf_dir, "documents"))
