"""From raw documents to encoded ones, stage by stage.

Each stage is a function of the session, the documents its predecessor kept and the data
folder; its result is written and read again before the next one runs.

1. language: documents without a letter, or of which no language has a clear share, go.
2. near duplicates: of documents linked by five-word shingles at a similarity of 0.8 or more, the one
   with the smallest id stays; a repeated row is the same document.
3. passages: words of passages that recur are removed; documents of which nothing is left go, and
   those that lose nothing stay as they are.
4. benchmark: documents that hold a region or passage of a benchmark item, or a short item, go.
5. encode: ids of each text and their digests, and that of what they decode to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from riskstream.llm import benchmark, encode, jaccard, language, passages
from riskstream.session import stored

#: A language with a smaller share than this isn't clear.
CLEAR = 0.4


def in_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language.fit(docs)
    others = F.struct(*(c for c in docs.columns if c != "text"))
    found = language.predict(docs.select(others.alias("row"), "text"), model, ["row", "text"])
    clear = found.where((F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= CLEAR))
    return clear.select(*(F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    key = [F.xxhash64("text").alias("k1"), F.xxhash64("doc_id", "text").alias("k2")]
    rows = docs.select(F.struct(*docs.columns).alias("row"), *key)
    found = jaccard.similar_documents(docs.select("doc_id", "text", *key), jaccard.Similarity(), ["k1", "k2", "doc_id"])
    alone = found.where("n_shingles = 0").select("k1", "k2")
    linked = found.where("n_shingles > 0 AND doc_id <=> component_id")
    first = linked.groupBy("component").agg(F.min(F.struct("k1", "k2")).alias("first")).select("first.*")
    kept = rows.join(alone.unionByName(first), ["k1", "k2"], "left_semi")
    once = F.row_number().over(Window.partitionBy("k1", "k2").orderBy("k1"))
    return kept.withColumn("nth", once).where("nth = 1").select("row.*")


def without_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    rows = docs.select(F.struct(*others, "n_chars").alias("row"), "doc_id", "text")
    left = passages.remove_passages(rows, ["row"], joined=False)
    changed = F.col("n_removed") > 0
    n_chars = F.when(changed, F.length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars"))
    columns = {"text": F.col("kept_text"), "n_chars": n_chars}
    kept = left.where("n_removed = 0 OR n_removed < n_words")
    return kept.select(*(columns.get(c, F.col("row")[c]).alias(c) for c in docs.columns))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return benchmark.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), short=True)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    vocabulary = encode.public_vocabulary("byte_bpe_50k.tiktoken")
    return encode.digests(docs, vocabulary, ["doc_id"])


STAGES = [
    ("language", in_a_language),
    ("near duplicates", without_near_duplicates),
    ("passages", without_passages),
    ("benchmark", without_benchmark),
    ("encode", encoded),
]
#: SQL can express neither the language model nor the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from the table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES):
            docs = stored(docs, name.replace(" ", "-"))
    return docs
