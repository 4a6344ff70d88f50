"""The registered queries of the subpackage, and the SQL that gives the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskstream.llm import benchmark, counts, encode, filters, jaccard, language, negatives, neighbours, passages, resampling, shards, suffixes, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(by: int):
    """The checksum of a document's id, modulo ``by``; a null id counts as an empty one."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % by


@query("op1_language_id")
def op1_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", (remainder(3) == 1).alias("held_out"))
    model = language.fit(docs.where("NOT held_out"))
    return language.predict(docs, model, ["doc_id", "held_out"])


@query("op2_toxicity")
def op2_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (remainder(4) == 2).alias("held_out"))
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(remainder(4) != 2))
    scored = toxicity.score(docs, model, ["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


#: The words of each document, as a list.
WORDS_SQL = r"SELECT doc_id, row_number() OVER () AS r, coalesce(regexp_extract_all({text}, '[^\x20\x09-\x0D]+'), []) AS words FROM documents"
LOWER_SQL = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op3_jaccard_join",
    f"""WITH RECURSIVE listed AS MATERIALIZED ({WORDS_SQL.format(text=LOWER_SQL)}),
    sets AS MATERIALIZED (
      SELECT DISTINCT r, array_to_string(words[i : i + 3], ' ') AS shingle FROM listed, unnest(generate_series(1, len(words) - 3)) AS t(i) WHERE len(words) >= 4
      UNION ALL SELECT r, array_to_string(words, ' ') FROM listed WHERE len(words) BETWEEN 1 AND 3),
    sizes AS MATERIALIZED (SELECT r, count(*) AS n FROM sets GROUP BY r),
    links AS MATERIALIZED (
      SELECT a, b FROM (SELECT x.r AS a, y.r AS b, count(*) AS common FROM sets x JOIN sets y ON x.shingle = y.shingle AND x.r <> y.r GROUP BY ALL) AS pairs
      JOIN sizes sa ON a = sa.r JOIN sizes sb ON b = sb.r WHERE 100 * common >= 85 * (sa.n + sb.n - common)),
    reached(r, c) AS (SELECT r, r FROM listed UNION SELECT reached.r, b FROM reached JOIN links ON c = a)
    SELECT listed.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other.doc_id) AS component_id
    FROM listed JOIN reached ON listed.r = reached.r JOIN listed AS other ON c = other.r LEFT JOIN sizes ON listed.r = sizes.r
    GROUP BY listed.r, listed.doc_id""",
)
def op3_jaccard_join(spark, sf_dir):
    similarity = jaccard.Similarity(words=4, share=(85, 100))
    return jaccard.similar_documents(table(spark, sf_dir, "documents"), similarity, ["doc_id"]).drop("component")


@query(
    "op3_jaccard_links",
    f"""WITH listed AS MATERIALIZED ({WORDS_SQL.format(text=LOWER_SQL)}),
    sets AS MATERIALIZED (
      SELECT DISTINCT r, array_to_string(words[i : i + 3], ' ') AS shingle FROM listed, unnest(generate_series(1, len(words) - 3)) AS t(i) WHERE len(words) >= 4
      UNION ALL SELECT r, array_to_string(words, ' ') FROM listed WHERE len(words) BETWEEN 1 AND 3),
    sizes AS MATERIALIZED (SELECT r, count(*) AS n FROM sets GROUP BY r),
    links AS MATERIALIZED (
      SELECT a, count(*) AS n_links FROM (SELECT x.r AS a, y.r AS b, count(*) AS common FROM sets x JOIN sets y ON x.shingle = y.shingle AND x.r <> y.r GROUP BY ALL) AS pairs
      JOIN sizes sa ON a = sa.r JOIN sizes sb ON b = sb.r WHERE 100 * common >= 85 * (sa.n + sb.n - common) GROUP BY a)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(n_links, 0) AS n_links
    FROM listed LEFT JOIN sizes ON listed.r = sizes.r LEFT JOIN links ON listed.r = a""",
)
def op3_jaccard_links(spark, sf_dir):
    similarity = jaccard.Similarity(words=4, share=(85, 100))
    found = jaccard.similar_documents(table(spark, sf_dir, "documents"), similarity, ["doc_id"], links=True)
    return found.select("doc_id", "n_shingles", "n_links")


@query("op4_decontamination")
def op4_decontamination(spark, sf_dir):
    leaks = benchmark.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    first = F.min(F.struct("start", "end", "edits")).alias("first")
    pairs = leaks.groupBy("doc_id", "item_id").agg(F.count(F.lit(1)).alias("n_regions"), first)
    return pairs.select("doc_id", "item_id", "n_regions", "first.*")


@query(
    "op5_substring_dedup",
    f"""WITH listed AS MATERIALIZED ({WORDS_SQL.format(text="text")}),
    starts AS MATERIALIZED (SELECT r, i, array_to_string(words[i : i + 34], ' ') AS passage FROM listed, unnest(generate_series(1, len(words) - 34)) AS t(i)),
    recurring AS (SELECT r, i FROM starts SEMI JOIN (SELECT passage FROM starts GROUP BY passage HAVING count(*) > 1) AS often USING (passage)),
    single AS (SELECT r, j, words[j] AS word FROM listed, unnest(generate_series(1, len(words))) AS t(j)),
    marked AS (SELECT single.r, j, word, coalesce(j - max(i) OVER (PARTITION BY single.r ORDER BY j) < 35, false) AS gone
      FROM single LEFT JOIN recurring ON single.r = recurring.r AND j = i)
    SELECT doc_id, len(any_value(words)) AS n_words, count(*) FILTER (WHERE gone) AS n_removed,
      sha256(coalesce(string_agg(word, ' ' ORDER BY j) FILTER (WHERE NOT gone), '')) AS kept_sha256
    FROM listed LEFT JOIN marked ON listed.r = marked.r GROUP BY listed.r, doc_id""",
)
def op5_substring_dedup(spark, sf_dir):
    left = passages.remove_passages(table(spark, sf_dir, "documents"), ["doc_id"])
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op6_shards")
def op6_shards(spark, sf_dir):
    rows = shards.assign_shards(table(spark, sf_dir, "documents"), 24, ["doc_id"])
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op7_token_counts")
def op7_token_counts(spark, sf_dir):
    merges = counts.public_merges("byte_bpe_50k.json")
    rows = counts.token_counts(table(spark, sf_dir, "documents"), merges, ["doc_id"])
    return rows.withColumn("over_limit", F.col("n_tokens") > 512)


@query("op8_nearest")
def op8_nearest(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where("vec_id % 20 = 0"))


@query("op9_encode")
def op9_encode(spark, sf_dir):
    vocabulary = encode.public_vocabulary("byte_bpe_50k.tiktoken")
    return encode.digests(table(spark, sf_dir, "documents"), vocabulary, ["doc_id"])


#: Host, start of the path, verdict.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
URL_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@query(
    "op10_url_filter",
    f"""WITH rules(rule_host, rule_path, verdict) AS (VALUES {", ".join(map(str, URL_RULES))}),
    parts AS (SELECT page_id, translate(coalesce(regexp_extract(url, '{URL_PARTS}', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(url, '{URL_PARTS}', 2), '') AS path, row_number() OVER () AS n FROM pages),
    fitting AS (SELECT n, rule_host || rule_path AS rule, verdict FROM parts JOIN rules
        ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
      QUALIFY row_number() OVER (PARTITION BY n ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) = 1)
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN fitting USING (n)""",
)
def op10_url_filter(spark, sf_dir):
    listed = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return filters.judge_urls(table(spark, sf_dir, "pages"), listed, ["page_id"])


@query(
    "op11_suffix_dedup",
    """WITH listed AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    pieces AS MATERIALIZED (SELECT r, c, substr(h, c + 1, 4398) AS p FROM listed, unnest(range(0, length(h), 4000)) AS t(c)),
    starts AS MATERIALIZED (SELECT r, c // 2 + i AS i, md5_number(substr(p, 2 * i - 1, 400)) AS w FROM pieces, unnest(range(1, least(2000, length(p) // 2 - 199) + 1)) AS t(i)),
    recurring AS MATERIALIZED (SELECT r, i FROM starts SEMI JOIN (SELECT w FROM starts GROUP BY w HAVING count(*) > 1) AS often USING (w)),
    runs AS (SELECT r, min(i) AS since, max(i) + 200 AS until FROM (SELECT r, i, sum(apart) OVER (PARTITION BY r ORDER BY i) AS run
      FROM (SELECT r, i, CAST(coalesce(i - lag(i) OVER (PARTITION BY r ORDER BY i) > 200, true) AS INTEGER) AS apart FROM recurring)) GROUP BY r, run),
    kept AS (SELECT r, count(*) AS n_spans, sum(until - since) AS n_removed, list(since ORDER BY since) AS since, list(until ORDER BY since) AS until FROM runs GROUP BY r)
    SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
      sha256(unhex(CASE WHEN n_spans IS NULL THEN h ELSE array_to_string(list_transform(range(0, n_spans + 1), lambda k:
        substr(h, CASE WHEN k = 0 THEN 1 ELSE 2 * until[k] - 1 END, 2 * (CASE WHEN k = n_spans THEN length(h) // 2 + 1 ELSE since[k + 1] END - CASE WHEN k = 0 THEN 1 ELSE until[k] END))), '') END)) AS kept_sha256
    FROM listed LEFT JOIN kept USING (r)""",
)
def op11_suffix_dedup(spark, sf_dir):
    left = suffixes.remove_recurring(table(spark, sf_dir, "documents"), ["doc_id"])
    n_spans = F.size("spans").cast("long").alias("n_spans")
    return left.select("doc_id", "n_bytes", "n_removed", n_spans, F.sha2("kept", 256).alias("kept_sha256"))


LETTERS_SQL = rf"regexp_extract_all({LOWER_SQL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(
    "op12_resampling",
    f"""WITH codes AS MATERIALIZED (SELECT list(c ORDER BY n) AS codes FROM (SELECT n, list_reduce(list_prepend(n, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c FROM range(256) AS t(n))),
    listed AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce({LETTERS_SQL}, []) AS words FROM documents),
    asked AS MATERIALIZED (SELECT unnest({LETTERS_SQL}) AS word FROM benchmark),
    features AS MATERIALIZED (SELECT r, unnest(words) AS word FROM listed),
    spelled AS MATERIALIZED (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM features UNION SELECT word FROM asked)),
    buckets AS MATERIALIZED (SELECT word, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(h), 2), lambda i: (instr('0123456789ABCDEF', h[i]) - 1) * 16 + instr('0123456789ABCDEF', h[i + 1]) - 1)),
        lambda c, b: xor(codes[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 10000 AS bucket FROM spelled, codes),
    own AS (SELECT bucket, count(*) AS s FROM features JOIN buckets USING (word) GROUP BY bucket),
    target AS (SELECT bucket, count(*) AS t FROM asked JOIN buckets USING (word) GROUP BY bucket),
    gains AS MATERIALIZED (SELECT bucket, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * ((SELECT count(*) FROM features) + 10000) / (CAST(s + 1 AS DOUBLE) * ((SELECT count(*) FROM asked) + 10000)))) AS BIGINT) AS gain
      FROM own LEFT JOIN target USING (bucket)),
    weights AS (SELECT r, CAST(sum(gain) AS BIGINT) AS weight FROM features JOIN buckets USING (word) JOIN gains USING (bucket) GROUP BY r),
    scored AS (SELECT doc_id, len(words) AS n_features, coalesce(weight, 0) AS weight,
      coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(('0x' || substr(sha256('2024:' || doc_id), 1, 8)) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM listed LEFT JOIN weights USING (r)),
    placed AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY n_features >= 20) AS n FROM scored)
    SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank FROM placed""",
)
def op12_resampling(spark, sf_dir):
    docs, target = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return resampling.resample(docs, target, ["doc_id"])


@query(
    "op13_hard_negatives",
    """WITH vectors AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
      WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    pairs AS MATERIALIZED (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
      FROM vectors a JOIN vectors b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
    positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
      vec_id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN pairs USING (anchor_id)
    WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score QUALIFY rank <= 3""",
)
def op13_hard_negatives(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = vectors.select("vec_id", label.alias("label"), "embedding")
    return negatives.hard_negatives(vectors, vectors.where("vec_id % 50 = 0"))
