"""Registered queries of the operators, and their SQL checks where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeplan.llm import (byte_bpe, collocations, common, exact_dedup, fingerprints, language, line_dedup, ngram_join, packing, pii, quality, token_counts,
                          toxicity, va_clusters)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


@query("op1_token_counts")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(common.documents(spark, sf_dir))


@query("op5_byte_bpe")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(common.documents(spark, sf_dir))


@query("op6_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(common.documents(spark, sf_dir))


@query("op7_exact_dedup", r"""
    WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
    SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept, text_sha256
    FROM d WINDOW g AS (PARTITION BY text_sha256)""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decisions(common.documents(spark, sf_dir))


@query("op2_quality")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(common.documents(spark, sf_dir), common.labels(spark, sf_dir))


@query("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(common.documents(spark, sf_dir), common.labels(spark, sf_dir))


@query("op3_language_id")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predictions(common.documents(spark, sf_dir))


@query("op8_fingerprints")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(common.documents(spark, sf_dir))


@query("op10_ngram_jaccard_join", r"""
    WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
          ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS shingle FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
    link AS (SELECT i.a, i.b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 90 * (x.n + y.n - i)),
    reach AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a)
    SELECT r.a AS doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.b) AS component_id FROM reach r LEFT JOIN n ON n.doc_id = r.a GROUP BY r.a""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_components(common.documents(spark, sf_dir))


@query("op4_line_dedup", r"""
    WITH l AS (SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                      unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS position FROM documents),
    k AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS bare FROM l),
    b AS (SELECT bare FROM k WHERE bare <> '' GROUP BY bare HAVING count(DISTINCT source) >= 5),
    m AS (SELECT k.*, b.bare IS NOT NULL AS removed FROM k LEFT JOIN b USING (bare)),
    c AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (removed) AS n_removed,
                 coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (NOT removed), '') AS clean FROM m GROUP BY doc_id)
    SELECT doc_id, n_lines, n_removed, length(clean) AS clean_chars, sha256(clean) AS clean_sha256 FROM c""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line that is not blank counts."""
    docs = common.documents(spark, sf_dir).select("doc_id", "text", "source")
    cleaned = line_dedup.without_boilerplate(docs)
    whole = common.whole_text()
    return cleaned.select("doc_id", "n_lines", "n_removed", F.length(whole).cast("long").alias("clean_chars"), F.sha2(whole, 256).alias("clean_sha256"))


def clusters_sql(k: int = 16, rounds: int = 3) -> str:
    """Every distance of every round, spelled out."""
    steps = [f"""
    v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
          WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
    x AS (SELECT vec_id, unnest(e) AS x, unnest(range(64)) AS i FROM v),
    c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS k, e AS c FROM v ORDER BY k LIMIT {k})"""]
    for i in range(rounds + 1):
        steps.append(f"""
    d{i} AS (SELECT vec_id, k, list_sum(list_transform(range(1, 65), lambda j: (e[j] - c[j]) * (e[j] - c[j])))::BIGINT AS d FROM v CROSS JOIN c{i}),
    a{i} AS (SELECT vec_id, k, d FROM d{i} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, k) = 1)""")
        if i < rounds:
            steps.append(f"""
    m{i} AS (SELECT k, i, sum(x)::BIGINT AS s, count(*) AS n FROM x JOIN a{i} USING (vec_id) GROUP BY ALL),
    c{i + 1} AS (SELECT k, coalesce(any_value(m.c), any_value(c{i}.c)) AS c FROM c{i} LEFT JOIN (
        SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM m{i} GROUP BY k) m USING (k) GROUP BY k)""")
    return f"""WITH {",".join(steps)}
    SELECT vec_id, CAST(k AS INTEGER) AS "cluster", d AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
           CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
    FROM a{rounds} JOIN c{rounds} USING (k)"""


@query("op11_va_file_clusters", clusters_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return va_clusters.clusters(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query("op12_phrase_collocations", r"""
    WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
    g AS (SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
          FROM w CROSS JOIN (SELECT unnest(range(1, 6)) AS size) WHERE len(w) >= size),
    f AS (SELECT lang, size, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
    n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
    c AS (SELECT *, string_split(phrase, ' ') AS words FROM f WHERE size > 1),
    k AS (SELECT *, unnest(range(1, size)) AS k FROM c),
    s AS (SELECT k.lang, k.phrase, k.f AS a, k.k, x.f AS l, y.f AS r, n.n,
                 ((1000::HUGEINT * k.f * n.n) // (x.f::HUGEINT * y.f))::BIGINT AS score
          FROM k JOIN n USING (lang) JOIN f x ON x.lang = k.lang AND x.phrase = array_to_string(k.words[1:k.k], ' ')
          JOIN f y ON y.lang = k.lang AND y.phrase = array_to_string(k.words[k.k + 1:], ' ')),
    b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    kept AS (SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.lang = b.lang AND length(c.phrase) > length(b.phrase)
                 AND contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' ') AND 100 * c.f >= 100 * b.a)),
    o AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM kept)
    SELECT * FROM o WHERE rank <= 2000""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(common.documents(spark, sf_dir))


@query("op13_personal_data")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(common.documents(spark, sf_dir))
