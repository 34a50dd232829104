"""Documents to training sequences: language ID, exact dedup, n-gram Jaccard join, mixing, packing.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame that is written as Parquet and read again as
the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import keep, pick, words
from tessera.llm.exact import exact_dedup
from tessera.llm.jaccard import one_of_each
from tessera.llm.language import UNKNOWN, predict
from tessera.llm.mixing import MOST, mix
from tessera.llm.packing import best_fit_packing

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Least posterior of the language that a document is kept with.
SURE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: texts without letters and those with a posterior below SURE go."""
    found = predict(docs, carried=COLUMNS)
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= SURE)).select(*COLUMNS)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that of the largest id."""
    return exact_dedup(docs, carried=COLUMNS).where("kept").select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts, that of the least id."""
    return one_of_each(pick(docs, *COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes: a row for a document's first and one for its second time.

    A document taken whole keeps its text; of one taken in part, the words of the blocks taken are
    joined by blanks. n_chars is that of the text returned; documents of which nothing is taken go.
    """
    found = mix(docs, carried=COLUMNS).where("taken > 0").withColumn("found", words(F.col("text")))

    def text_of(turn: int):
        taken = F.filter("spans", lambda s: s["copies"] >= turn)
        cut = F.array_join(F.flatten(F.transform(taken, lambda s: F.slice("found", (s["from"] + 1).cast("int"), (s["to"] - s["from"]).cast("int")))), " ")
        return F.when(F.size(taken) == F.size("spans"), F.col("text")).when(F.size(taken) > 0, cut)

    rows = found.withColumn("text", F.explode(F.array_compact(F.array(*[text_of(turn) for turn in range(1, MOST + 1)]))))
    return rows.select("doc_id", "text", "lang", "source", F.char_length("text").cast("bigint").alias("n_chars"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of at most 4096 tokens."""
    return best_fit_packing(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_copies),
    ("ngram_jaccard", near_copies),
    ("mix_sources", mix_sources),
    ("pack", pack_sequences),
]

#: The first and last stages (a fitted model, a tokenizer) have no SQL; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
