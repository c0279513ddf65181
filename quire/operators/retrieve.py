"""Character n-gram TF-IDF: an exact index, and top-k contexts by cosine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.operators.groups import dealt


def grams(c: Column, low: int = 2, high: int = 4) -> Column:
    """All character n-grams of the lower-case text with white space squeezed."""
    own = F.regexp_replace(F.lower(c), r"(?U)\s\s+", " ")
    one = lambda n: F.when(F.length(own) >= n, F.transform(F.sequence(F.lit(1), F.length(own) - n + 1), lambda i: F.substring(own, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))
    return F.concat(*[one(n) for n in range(low, high + 1)])


def counts(rows: DataFrame, key: str, text: str, weight: str | None = None) -> DataFrame:
    """key, gram, tf. Texts are dealt by key before they become grams, so that grams are counted where they are made."""
    w = F.col(weight) if weight else F.lit(1)
    own = dealt(rows.select(F.col(key).alias("key"), w.alias("w"), F.col(text).alias("text")), "key", mb=0.5)
    own = own.select("key", "w", F.explode(grams(F.col("text"))).alias("gram"))
    return own.groupBy("key", "gram").agg(F.sum("w").alias("tf"))


def index(rows: DataFrame, key: str, text: str, weight: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Vectors (key, gram, x) of length one, and idf (gram, idf): ln((1 + N) / (1 + df)) + 1 over all rows."""
    tf = counts(rows, key, text, weight)
    n = rows.agg(F.count("*").alias("n"))
    idf = tf.groupBy("gram").agg(F.count("*").alias("df")).join(F.broadcast(n)).select("gram", (F.log((1.0 + F.col("n")) / (1.0 + F.col("df"))) + 1.0).alias("idf"))
    return normed(tf, idf), idf


def normed(tf: DataFrame, idf: DataFrame) -> DataFrame:
    """Grams outside the index are left out before the length is taken.

    The hint keeps grams from being broadcast: Spark judges them by the bytes of the texts, from before they are exploded.
    """
    own = dealt(tf.join(idf.hint("shuffle_hash"), "gram").select("key", "gram", (F.col("tf") * F.col("idf")).alias("x")), "key", mb=0.5)
    size = F.sqrt(F.sum(F.col("x") * F.col("x")).over(Window.partitionBy("key")))
    return own.select("key", "gram", (F.col("x") / size).alias("x"))


def top_k(queries: DataFrame, q_key: str, q_text: str, rows: DataFrame, key: str, text: str, k: int = 20) -> DataFrame:
    """Query, key, score, rank: the k rows of the highest cosine; equal scores by key. Queries without a gram have none.

    Only rows that share a gram with a query meet it, and pairs are summed before they are ranked; the rank's window keeps
    k rows a task before the shuffle.
    """
    vectors, idf = index(rows, key, text)
    wanted = normed(counts(queries, q_key, q_text), idf).select(F.col("key").alias("query"), "gram", F.col("x").alias("q"))
    scores = vectors.join(wanted.hint("shuffle_hash"), "gram").groupBy("query", "key").agg(F.round(F.sum(F.col("x") * F.col("q")), 9).alias("score"))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "key"))
    return scores.withColumn("rank", rank.cast("long")).where(F.col("rank") <= k)
