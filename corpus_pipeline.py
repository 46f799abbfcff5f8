"""Corpus pipeline: five stages over ``documents``, each on all its predecessor kept.

``run(spark, sf_dir)`` applies ``STAGES`` in order; each result is written as
Parquet to the shared folder and read again as the next stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import chain_dedup, langid, simhash_trie, soft_mix, template_decontam
from tessera.llm.common import stored
from tessera.llm.queries import MIXTURE, label_domains


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language.

    Those go whose text is null or has no letter, and those whose words are,
    by their median score a byte, far less likely in every learned language
    than the texts it was learned from (``langid.floors_of``): gibberish and
    languages that were not learned. Every row is judged by its own text, so
    repeated rows and rows with a null id stay or go alike. Where no language
    can be learned (no row has one), nothing stays.
    """
    learned = docs.where(~langid.held_out())
    languages, probability = langid.fit(learned)
    # Every text is scored once; the floors are read off the scores of all texts that the languages were learned from.
    out = stored(langid.predict(docs, languages, probability, lang_name="__lang", score_name="__score", typical_name="__typical"), "language-scores")
    floors = langid.floors_of(out.where(~langid.held_out()), "lang", "__lang", "__typical") if languages else {}
    floor = F.lit(None).cast("double")
    for language, least in floors.items():
        floor = F.when(F.col("__lang") == language, least).otherwise(floor)
    return (out.where((F.col("__lang") != langid.UND) & F.coalesce(F.col("__typical") >= floor, F.lit(True)))
            .drop("__lang", "__score", "__typical"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, that with the smallest id; of rows that repeat it, one.

    Fingerprints of three words link at three differing bits, so only copies
    with very few changed words meet: about half of the planted near copies.
    """
    return simhash_trie.keep_one(docs, size=3, max_bits=3)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that repeat earlier ones; a text of which nothing is left goes.

    Earlier is the smaller id, then the smaller position. Rows with a null id
    stay as they are; null, empty and blank texts go. Rows that repeat an id
    lose the same passages. ``n_chars``, if there, is counted again; all
    other columns stay, whatever their names.
    """
    passages = stored(chain_dedup.repeated_passages(docs), "passages")
    cut = chain_dedup.cut_passages(docs, passages).where(F.col("text").rlike(r"\S"))
    if "n_chars" not in docs.columns:
        return cut
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item.

    Rows that repeat an id go together if one of them leaks; rows with a null
    id or text leak nothing and stay.
    """
    return template_decontam.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mixture with their ``rate`` and number of ``copies`` (in place of columns so named).

    Rows that repeat an id get the largest of its rates; null ids count as one id.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rates = (soft_mix.mix(docs, label_domains(labels), MIXTURE).groupBy(F.col("doc_id").alias("__id"))
             .agg(F.max("rate").alias("rate"), F.max("copies").alias("copies")))
    docs = docs.drop("rate", "copies")
    return docs.join(rates, docs["doc_id"].eqNullSafe(rates["__id"])).where("copies > 0").drop("__id")


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
]

#: Language models, chaining and rates have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
