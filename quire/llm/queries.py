"""The queries opN_<name>: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import automaton, bpe, decontaminate, jaccard, jpeg, nbsvm, ppm, sql, subword, suffixes, warc
from quire.llm.common import crc_mod, documents, labels, materialize, scratch_dir


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return automaton.remove_repeats(documents(spark, sf_dir))


def op2_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = nbsvm.train(docs, labels(spark, sf_dir).where(crc_mod("doc_id", 4) != 2), "quality")
    return nbsvm.score(docs, model, ["doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out")], 0.7)


def op3_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.removed_passages(documents(spark, sf_dir))


def op4_subword(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = subword.train(docs, labels(spark, sf_dir).where(crc_mod("doc_id", 4) != 2), "toxic")
    return nbsvm.score(docs, model, ["doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out")], 0.3)


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(documents(spark, sf_dir))


def op6_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = ppm.Model(ppm.sample(docs.where(crc_mod("doc_id", 5) != 0)))
    return ppm.identify(docs, model, ["doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out")])


def op7_jpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    media = materialize(jpeg.write_media(documents(spark, sf_dir), "doc_id", "text"), "media")
    return jpeg.read_media(media, "doc_id").select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "width", "height")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "warc")
    warc.write_archives(warc.with_revisits(spark.read.parquet(f"{sf_dir}/pages.parquet")), path)
    back = warc.read_archives(spark, path)
    # what was just written has no gaps; one would leave pages out, so it fails the query
    whole = F.when(F.col("kind") == "record", F.col("page_id")).otherwise(F.raise_error(F.concat(F.lit("a gap in "), "file", F.lit(": "), "reason")).cast("long"))
    return back.select(whole.alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(documents(spark, sf_dir), tokenizer_path())


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_automaton": op1_automaton,
    "op2_nbsvm": op2_nbsvm,
    "op3_suffixes": op3_suffixes,
    "op4_subword": op4_subword,
    "op5_jaccard": op5_jaccard,
    "op6_ppm": op6_ppm,
    "op7_jpeg": op7_jpeg,
    "op8_warc": op8_warc,
    "op9_bpe": op9_bpe,
    "op10_decontaminate": op10_decontaminate,
}

ORACLE_SQL: dict[str, str] = {"op1_automaton": sql.REPEATS, "op3_suffixes": sql.PASSAGES, "op5_jaccard": sql.LINKS, "op8_warc": sql.ARCHIVE}
