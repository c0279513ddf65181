"""The corpus pipeline: five stages over `documents`, each one operator of quire.llm, each written before the next reads it.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns the columns of `documents`;
the last returns tokens. Each is judged on its own input:

1. language ID: a document without a letter, which has no language, is rejected and goes; all others stay, those of
   languages that no label names too;
2. n-gram Jaccard join: of each group of linked documents the one with the smallest id stays;
3. suffix-array dedup: passages of 50 words or more stay where they are first; elsewhere they are cut out of the text;
4. benchmark decontamination: a document that holds a benchmark item, as a copy or edited, goes;
5. BPE encoding and decoding: token ids, their digest, and the digest of what they decode to.

Defined results: null and empty texts go in stage 1; so stages 2 to 5 see none but texts that stage 3 emptied, which
stay as empty texts; of rows of equal id and text one stays in stage 2; documents without an id are judged like all
others, each by its own text, and yield to those with one where they are copies; extra columns pass through all stages
but the last; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import bpe, decontaminate, jaccard, ppm, suffixes
from quire.llm.common import crc_mod, documents, materialize
from quire.llm.queries import tokenizer_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = ppm.Model(ppm.sample(docs.where(crc_mod("doc_id", 5) != 0)))
    found = ppm.identify(docs, model, [F.struct(*docs.columns).alias("__doc")])
    return found.where(F.col("lang_pred") != ppm.UNKNOWN).select(*[F.col("__doc")[c].alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.representatives(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = suffixes.without_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(docs, tokenizer_path(), with_ids=True)


STAGES = [
    ("language ID", language_id),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", benchmark_free),
    ("BPE encoding and decoding", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


#: Context trees, alignments and BPE have no SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None
