"""Documents to training tokens: language, exact and near duplicates, source mix, pieces.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return
the columns of documents, whatever others there are and whatever they are called. Null and empty texts, ties,
repeated rows and empty tables have a defined result in every stage, told in its docstring; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import clearing, discard, new_path, observed, sized_join
from lectern.llm.exact_dedup import exact_dedup
from lectern.llm.language_id import fit, language_of
from lectern.llm.mixing import in_training_order, mix
from lectern.llm.near_dedup import near_dedup
from lectern.llm.queries import model_file
from lectern.llm.sentence_pieces import encode


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter, and those too unlike every language learned from the labelled ones.

    Null and empty texts have no letter. Each row is judged by its own text, so repeated rows stay or go together; null
    labels teach nothing.
    """
    model = fit(docs.select(F.col("doc_id").alias("id"), "text", "lang"))
    judged = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), language_of(docs, docs["text"], model).alias("found"))
    return judged.filter(~F.col("found.rejected")).select("row.*")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row with the smallest id of texts that are equal up to white space; null texts count as empty.

    A null id is kept only where no row of the group has one; of rows that share text and id one is kept.
    """
    return exact_dedup(docs).filter("kept").select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each near-duplicate group.

    Texts without words are near nothing and stay. Rows that share id and text stay or go together.
    """
    key = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("-")).alias("_id")
    dropped = near_dedup(docs).filter("not kept").select(key("doc_id"), F.col("text_key").alias("_key")).distinct()
    dropped, seen = observed(dropped, "dropped", many=F.count("*"), size=F.coalesce(F.sum(F.octet_length("_id") + 16), F.lit(0)))
    keyed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), key("doc_id"), F.xxhash64(docs["text"]).alias("_key"))
    return sized_join(keyed, dropped, ["_id", "_key"], "left_anti", known=(seen["many"], seen["size"])).select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in training order, as often as the mix takes them.

    Null texts have no words and are not taken; null sources are one source. Rows that tie in source, id and text are
    alike, so reruns take the same. The last document of a source is given whole, though the mix takes only its beginning.
    """
    return in_training_order(mix(docs))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, ids and n_tokens of every row, repeated ones too; null and empty texts have no ids."""
    found = encode(docs, model_file(spark), keep=["doc_id", "source"])
    return found.select("row.*", "ids", F.size("ids").cast("long").alias("n_tokens"))


STAGES = [
    ("language", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mix", mix_sources),
    ("encode", encode_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again; what a stage needed is deleted once the next one's rows are written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = new_path(spark, f"stage-{name}")
        with clearing(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before is not None:
            discard(before)
        docs = before = spark.read.parquet(path)
    return docs


#: Language models and the best path of pieces are beyond SQL; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None
