"""The registered queries of this subpackage and the SQL of those that SQL expresses."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.llm import (
    bitsliced,
    chat,
    collocations,
    compression,
    jaccard,
    language,
    mixing,
    packing,
    pages,
    quality,
    repair,
    repeats,
    vectors,
)
from cardwarden.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def _query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        @functools.wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return build(spark, sf_dir)

        QUERIES[build.__name__] = run
        if sql:
            ORACLE[build.__name__] = sql
        return build

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@_query()
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized, sources, cells = mixing.mix(_table(spark, sf_dir, "documents"))
    copies = mixing.copies()
    return (
        sized.join(cells, mixing.CELL, "left")
        .join(sources, mixing.SOURCE)
        .select(
            "doc_id",
            F.col("_size").alias("size"),
            F.col("_words").alias("source_size"),
            F.col("_target").alias("target"),
            (copies * F.col("_size")).alias("taken"),
            copies.alias("copies"),
            F.when(F.col("_size") == 0, F.lit(1.0)).otherwise(F.col("_rate")).alias("rate"),
        )
    )


@_query()
def op8_pack_power_of_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return packing.pack(docs, tokenizer_path(), ["doc_id"], ids=False)


@_query()
def op9_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression.measure(_table(spark, sf_dir, "documents"), ["doc_id"])


_WORDS = r"'[^\x20\x09-\x0D]+'"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@_query(
    f"""WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, {_WORDS}) AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i : i + 4], ' ') FOR i IN range(1, len(w) - 3)])
    END AS s FROM worded
), sized AS (SELECT doc_id, s, len(s) AS n FROM sets),
shingles AS MATERIALIZED (SELECT doc_id, n, unnest(s) AS g FROM sized),
links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b USING (g)
  WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM sized
  UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, min(b) AS component_id
FROM sized JOIN reach ON reach.a = doc_id GROUP BY doc_id, n"""
)
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.grouped(jaccard.join(_table(spark, sf_dir, "documents")))
    return found.select("doc_id", "n_shingles", "component_id")


@_query(
    f"""WITH worded AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS w FROM documents
), listed AS (
  SELECT doc_id, len(w) AS text_words,
    [md5(array_to_string(w[i : i + 49], ' ')) FOR i IN range(1, len(w) - 48)] AS p FROM worded
), passages AS (
  SELECT doc_id, text_words, unnest(p) AS p, generate_subscripts(p, 1) - 1 AS pos FROM listed
), placed AS (
  SELECT *, first_value(doc_id) OVER same AS doc0, first_value(pos) OVER same AS at0 FROM passages
  WINDOW same AS (PARTITION BY p ORDER BY doc_id, pos)
), again AS (
  SELECT *, pos > coalesce(max(pos) OVER earlier + 50, -1) AS opens FROM placed
  WHERE doc_id <> doc0 OR pos <> at0
  WINDOW earlier AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), numbered AS (
  SELECT *, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY pos) AS span FROM again
)
SELECT doc_id, min(pos) AS start, max(pos) + 50 - min(pos) AS n_words, any_value(text_words) AS text_words,
  arg_min(doc0, pos) AS first_doc_id, arg_min(at0, pos) AS first_start
FROM numbered GROUP BY doc_id, span"""
)
def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.find(_table(spark, sf_dir, "documents")).drop("k1", "k2")


@_query()
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents: the language column is the declared one, the source the host."""
    docs = _table(spark, sf_dir, "documents")
    none = F.lit(None).cast("string")
    return language.identify(
        docs, ["doc_id"], F.col("text"), F.col("lang"), none, F.col("source")
    )


@_query()
def page_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages: declared by the html tag; the address gives host, last label and path."""
    table = _table(spark, sf_dir, "pages")
    url, html = F.col("url"), F.col("html")
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    path = F.regexp_extract(url, r"^[^/]*//[^/?#]*/([A-Za-z]{2})(?:[/?#]|$)", 1)
    suffix = F.concat(F.regexp_extract(host, r"([^.]+)$", 1), F.lit("/"), path)
    markup = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>"
    tag = F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z-]+)", 1)
    return language.identify(
        table, ["page_id"], F.regexp_replace(html, markup, " "), tag, suffix, host
    )


@_query()
def op7_quality_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    model = quality.fit(docs, labels.where(~quality.held_out(F.col("doc_id"))))
    return quality.score(docs, model, ["doc_id"]).select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@_query(
    """WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0
), links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b USING (label)
  WHERE a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), counted AS (SELECT a, count(*) AS n FROM links GROUP BY a),
named AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, c AS component_id, vec_id = c AS kept
FROM embeddings JOIN named ON named.a = vec_id LEFT JOIN counted ON counted.a = vec_id"""
)
def op6_itq_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(_table(spark, sf_dir, "embeddings"))


_PLACED = """placed AS (
  SELECT *, turn - min(turn) OVER (PARTITION BY conv_id) AS pos
  FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations
    WHERE conv_id IS NOT NULL AND turn IS NOT NULL)
), said AS (
  SELECT conv_id, list(hash(pos, role, text) ORDER BY pos, role, text) AS items,
    string_agg('<|im_start|>' || replace(coalesce(role, 'unknown'), '<|', '< |') || chr(10)
      || replace(coalesce(text, ''), '<|', '< |') || '<|im_end|>' || chr(10), ''
      ORDER BY pos, role, text) AS text,
    max(pos) AS last
  FROM placed GROUP BY conv_id
)"""


@_query(
    f"""WITH {_PLACED}, logged AS (
  SELECT min(conv_id) AS conv_id, items, count(*) AS n_logged FROM said GROUP BY items
), maximal AS (
  SELECT * FROM logged a WHERE NOT EXISTS (
    SELECT 1 FROM logged b WHERE b.items[1] = a.items[1] AND len(b.items) > len(a.items)
      AND b.items[1 : len(a.items)] = a.items)
)
SELECT conv_id, CAST(0 AS BIGINT) AS part, CAST(len(maximal.items) AS BIGINT) AS n_turns,
  n_logged, text FROM maximal JOIN said USING (conv_id)"""
)
def op3_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(_table(spark, sf_dir, "conversations"))


@_query()
def op4_consensus_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(_table(spark, sf_dir, "pages"), ["page_id", "url"])


@_query()
def op13_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir, "conversations")
    return repair.digests(repair.damage(table), table)


@_query(
    """WITH usable AS (
  SELECT row_number() OVER () AS rid, vec_id,
    [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings WHERE len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.rid AS query_rid, q.vec_id AS query_id, c.vec_id, c.rid,
    CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM usable q JOIN usable c ON len(q.v) = len(c.v) AND q.rid <> c.rid WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_rid ORDER BY score DESC, vec_id NULLS LAST, rid) AS rank
  FROM scored
)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM ranked WHERE rank <= 5"""
)
def op12_top_k_bit_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = bitsliced.quantised(_table(spark, sf_dir, "embeddings"))
    return bitsliced.search(vectors, vectors.where(F.col("vec_id") % 50 == 0))


@_query(
    f"""WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM worded GROUP BY lang),
grams AS (
  SELECT lang, k.k AS words,
    unnest([array_to_string(w[i : i + k.k - 1], ' ') FOR i IN range(1, len(w) - k.k + 2)]) AS phrase
  FROM worded, range(1, 6) AS k(k)
), f AS MATERIALIZED (
  SELECT lang, phrase, words, count(*) AS f FROM grams GROUP BY lang, phrase, words
  HAVING count(*) >= 100
), listed AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE words > 1),
inside AS (
  SELECT lang, f, unnest(flatten([[array_to_string(w[i : i + k - 1], ' ')
    FOR i IN range(1, words - k + 2)] FOR k IN range(2, words)])) AS phrase
  FROM listed WHERE words > 2
), own AS (
  SELECT * FROM listed c WHERE NOT EXISTS (
    SELECT 1 FROM inside i WHERE i.lang = c.lang AND i.phrase = c.phrase AND 100 * i.f >= 100 * c.f)
), cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, k.k, array_to_string(w[1 : k.k], ' ') AS head,
    array_to_string(w[k.k + 1 :], ' ') AS tail
  FROM own c, range(1, 5) AS k(k) WHERE k.k < c.words
), scored AS (
  SELECT cuts.*, x.f AS l, y.f AS r, n,
    (1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = head
  JOIN f y ON y.lang = cuts.lang AND y.phrase = tail JOIN total ON total.lang = cuts.lang
), least AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nth FROM scored
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM least WHERE nth = 1
)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000"""
)
def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(_table(spark, sf_dir, "documents"))
