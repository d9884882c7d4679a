"""From raw documents to token ids: five stages, each written and read again before the next."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import langid, mixing, pieces, secrets, simhash
from orderlens.llm.common import fold
from orderlens.llm.queries import PIECE_MODEL, table, tokenizer_file
from orderlens.session import pin, temporary, tune

#: Share of a text's n-grams that its language must hold.
LEAST_LANGUAGE_SCORE = 0.2


def set_apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` under column names that no operator adds columns by, and the new name of each column."""
    apart = {c: f"kept {c}" for c in docs.columns}
    return docs.select(*[docs[c].alias(new) for c, new in apart.items()]), apart


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a recognisable language go; a missing language is filled in.

    Texts of one-letter words have no n-gram to go by and stay, ``und`` where their language is missing.
    All other columns come through unchanged, whatever their names.
    """
    model = langid.learn(docs, fold("doc_id", 4) != 2)
    renamed, apart = set_apart(docs)
    marked = langid.predict(renamed, model, text=apart["text"], grams=True)
    silent = F.col("n_grams") == 0
    kept = marked.filter(
        (F.col("lang_pred") != langid.UNDECIDED) & (silent | (F.col("score") >= LEAST_LANGUAGE_SCORE)))
    told = F.when(silent, langid.UNDECIDED).otherwise(F.col("lang_pred"))
    filled = kept.withColumn(apart["lang"], F.coalesce(kept[apart["lang"]], told))
    return filled.select(*[filled[new].alias(c) for c, new in apart.items()])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return simhash.distinct_documents(docs, shingle=3, distance=3)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are hidden in the texts."""
    return secrets.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training order: a row per copy that the mix takes."""
    renamed, apart = set_apart(docs)
    mixed = mixing.mix(renamed, key=apart["doc_id"], text=apart["text"], source=apart["source"])
    return mixed.select(*[mixed[new].alias(c) for c, new in apart.items()])


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every row's text, and the length and crc32 of what decoding them gives back."""
    return pieces.encode(docs, tokenizer_file(PIECE_MODEL), keep=["doc_id", "lang", "source"], decoded=True)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("source_mix", source_mix),
    ("sentencepiece", token_ids),
]

#: Learned models, XXH64 and piece searches have no SQL form; a test makes each stage's rows again in plain Python.
ORACLE_SQL = None


def apply_stages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    for name, stage in STAGES:
        docs = pin(stage(spark, docs, sf_dir), name)
    return docs


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_stages(spark, table(spark, sf_dir, "documents"), sf_dir)


def main(argv=None) -> None:
    """Job for spark-submit: documents in, rows of the last stage out; what lies between is deleted at the end."""
    parser = argparse.ArgumentParser(description=main.__doc__)
    parser.add_argument("--tables", required=True, help="folder that holds documents.parquet")
    parser.add_argument("--output", required=True, help="new folder for the token ids")
    args = parser.parse_args(argv)
    spark = tune(SparkSession.builder.appName("corpus-pipeline").getOrCreate())
    with temporary(spark):
        run(spark, args.tables).write.parquet(args.output)


if __name__ == "__main__":
    main()
