"""The operators of this subpackage as queries over the driver's tables, read whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carespan.llm import attention_lm, bm25, cover_lloyd, mixing, nn_descent, quality, sentencepiece_codec, setsketch, simhash, stripes, toxicity, url_filter
from carespan.llm.common import LOWER, UPPER, WORD, table, tokenizer_file
from carespan.llm.token_files import TokenFiles
from carespan.sources.staging import new_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op2_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    encoded = sentencepiece_codec.encode_rows(docs, tokenizer_file("piece_bpe_32k.model"))
    return encoded.drop("text", "ids")


@query
def op3_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return bm25.like_documents(table(spark, folder, "documents"), F.col("doc_id") % 50 == 0, words=None)


@query
def op4_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return nn_descent.search(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op5_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return attention_lm.score_documents(table(spark, folder, "documents"), tokenizer_file("byte_bpe_50k.tiktoken"))


@query
def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    files = TokenFiles.write(docs, new_path(spark, "token-files"), tokenizer_path=tokenizer_file("byte_bpe_50k.json"))
    return files.report(docs.select(F.col("doc_id").alias("key")))


@query
def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(
        "doc_id", "source", mixing.word_count(F.col("text")).alias("words")
    )
    return mixing.mix(docs, size=F.col("words")).select(
        "row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


@query
def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(table(spark, folder, "pages").select("page_id", "url"))


@query
def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op10_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, folder, "documents"))


@query
def op11_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query
def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return cover_lloyd.compress(table(spark, folder, "embeddings"))


@query
def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return stripes.collocations(table(spark, folder, "documents"))


ORACLES: dict[str, str] = {
    "op7_mixing": rf"""
        WITH docs AS (
            SELECT doc_id, source,
                   CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size
            FROM documents),
        sources AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                   1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
            FROM docs GROUP BY source),
        filling AS (
            SELECT *, 3 * source_size AS cap, row_number() OVER f2 AS nth,
                   (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER f, 0))
                     / (sum(weight) OVER () - coalesce(sum(weight) OVER f, 0)) AS level
            FROM sources
            WINDOW f AS (ORDER BY 3 * source_size / weight, source NULLS LAST
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                   f2 AS (ORDER BY 3 * source_size / weight, source NULLS LAST)),
        level AS (SELECT arg_min(level, nth) AS level FROM filling WHERE cap > weight * level),
        targets AS (
            SELECT source, source_size,
                   CASE WHEN cap <= weight * coalesce(l.level, 0) THEN CAST(cap AS DOUBLE)
                        ELSE weight * l.level END AS target
            FROM filling, level l),
        placed AS (
            SELECT d.doc_id, d.size, t.source_size, t.target,
                   t.target / nullif(t.source_size, 0) AS expected,
                   row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id) - 1 AS place,
                   (CAST('0x' || left(md5('mix:' || coalesce(d.source, '')), 3) AS INTEGER) + 0.5::DOUBLE) / 4096 AS start
            FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
        SELECT doc_id, size, source_size, target,
               CAST(coalesce(floor(start + (place + 1) * expected) - floor(start + place * expected), 0) AS BIGINT)
                 * size AS taken
        FROM placed""",
}


def vector_codes_sql() -> str:
    """Rounds of comparing every part with every entry, in whole numbers."""
    ctes = ["""
        kept AS MATERIALIZED (
            SELECT vec_id, label, embedding FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
        places AS MATERIALIZED (
            SELECT vec_id, i * 8 // len(embedding) AS part, i % (len(embedding) // 8) AS place,
                   CAST(floor(4096 * CAST(embedding[i + 1] AS DOUBLE)) AS BIGINT) AS x
            FROM kept, unnest(range(len(embedding))) AS t(i)),
        first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT 16),
        book0 AS MATERIALIZED (SELECT part, entry, place, x AS y FROM places JOIN first USING (vec_id))"""]  # fmt: skip
    for i in range(7):
        ctes.append(f"""
        near{i} AS MATERIALIZED (
            SELECT vec_id, part, min(d * 16 + entry) // 16 AS error, min(d * 16 + entry) % 16 AS entry
            FROM (SELECT vec_id, part, entry, CAST(sum((x - y) * (x - y)) AS BIGINT) AS d
                  FROM places JOIN book{i} USING (part, place) GROUP BY vec_id, part, entry)
            GROUP BY vec_id, part)""")
        if i < 6:
            ctes.append(f"""
        book{i + 1} AS MATERIALIZED (
            SELECT part, entry, place, coalesce((s - ((s % n) + n) % n) // n, y) AS y
            FROM book{i} LEFT JOIN (
                SELECT part, entry, place, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
                FROM places JOIN near{i} USING (vec_id, part) GROUP BY part, entry, place)
            USING (part, entry, place))""")
    return f"""
        WITH {",".join(ctes)},
        digest AS (SELECT sha256(string_agg(y, ',' ORDER BY part, entry, place)) AS codebooks_sha256 FROM book6),
        coded AS (
            SELECT vec_id, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code,
                   CAST(sum(error) AS BIGINT) AS error
            FROM near6 GROUP BY vec_id)
        SELECT vec_id, code, error,
               CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
        FROM coded JOIN kept USING (vec_id), digest"""


ORACLES["op12_vector_codes"] = vector_codes_sql()

ORACLES["op13_collocations"] = rf"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents),
    words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
    seen AS MATERIALIZED (
        SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3 FROM words, unnest(range(1, len(w) + 1)) AS t(i)),
    one AS MATERIALIZED (SELECT lang, w1, count(*) AS f FROM seen GROUP BY ALL),
    two AS MATERIALIZED (SELECT lang, w1, w2, count(*) AS f FROM seen WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
    three AS MATERIALIZED (
        SELECT lang, w1, w2, w3, count(*) AS f FROM seen WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
    longer AS (
        SELECT lang, w1, w2, max(f) AS f
        FROM (SELECT lang, w1, w2, f FROM three UNION ALL SELECT lang, w2, w3, f FROM three) GROUP BY ALL),
    cuts AS (
        SELECT t.lang, t.w1 || ' ' || t.w2 AS phrase, t.f AS a, 1 AS k, x.f AS l, y.f AS r
        FROM two t JOIN one x ON x.lang = t.lang AND x.w1 = t.w1 JOIN one y ON y.lang = t.lang AND y.w1 = t.w2
        LEFT JOIN longer g ON g.lang = t.lang AND g.w1 = t.w1 AND g.w2 = t.w2
        WHERE NOT coalesce(100 * g.f >= 50 * t.f, false)
        UNION ALL
        SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 1, x.f, y.f
        FROM three t JOIN one x ON x.lang = t.lang AND x.w1 = t.w1
        JOIN two y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
        UNION ALL
        SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 2, x.f, y.f
        FROM three t JOIN two x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2
        JOIN one y ON y.lang = t.lang AND y.w1 = t.w3),
    scored AS (
        SELECT *, CAST(1000000::HUGEINT * a * a // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts
        QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY 1000000::HUGEINT * a * a // (l::HUGEINT * r), k) = 1)
    SELECT lang, rank, phrase, a, l, r, n, score
    FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM scored)
    JOIN (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM one GROUP BY lang) USING (lang)
    WHERE rank <= 2000"""
