"""Token counts (operator 10): an exact histogram of encoded lengths, and suffix sums over it for every context limit.

One aggregation over the documents, kept in the shared folder so texts are encoded once; all totals, quantiles and truncated totals are then read off the histogram, which has one row a
distinct length. The suffix sums run within blocks of lengths and over the blocks' totals, so no task sorts all lengths.

Defined results: null and empty texts have length 0 and count as documents; repeated rows count each time; an empty table gives an
empty histogram; very long texts count whole; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sagaframe.llm.bpe import encode
from sagaframe.session import cut

BLOCK = 64


def histogram(docs: DataFrame, path: str = "word_bpe_49k.json", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """n_tokens, n_docs."""
    return cut(encode(docs, path, id_col, text_col, "counts").groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs")))


def suffix_sums(hist: DataFrame) -> DataFrame:
    """For each length: documents and tokens of at least it, all of them, tokens if every document were cut to it, share of documents up to it."""
    blocked = hist.withColumn("tokens", F.col("n_tokens") * F.col("n_docs")).withColumn("block", F.floor(F.col("n_tokens") / BLOCK))
    inside = Window.partitionBy("block").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, 0)
    later = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = (
        blocked.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
        .select("block", *[F.coalesce(F.sum(c).over(later), F.lit(0)).alias(f"{c}_later") for c in "dt"], F.sum("d").over(whole).alias("all_docs"), F.sum("t").over(whole).alias("all_tokens"))
    )
    at = blocked.join(totals, "block").select(
        "n_tokens", "n_docs",
        (F.sum("n_docs").over(inside) + F.col("d_later")).alias("docs_at_least"),
        (F.sum("tokens").over(inside) + F.col("t_later")).alias("tokens_at_least"),
        "all_docs", "all_tokens",
    )
    return at.withColumn("truncated_tokens", F.col("all_tokens") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")).withColumn("share_up_to", (F.col("all_docs") - F.col("docs_at_least") + F.col("n_docs")) / F.col("all_docs"))


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """context_limit, docs_over, truncated_tokens for any limits, read off the suffix sums at the first length above each limit.

    One aggregation with partial sums, an expression a limit; an empty histogram gives zeros.
    """
    row = F.struct("n_tokens", "docs_at_least", "tokens_at_least")
    above = [F.min(F.when(F.col("n_tokens") > F.lit(int(x)), row)).alias(f"a{k}") for k, x in enumerate(limits)]
    one = sums.agg(F.coalesce(F.max("all_tokens"), F.lit(0)).alias("all_tokens"), *above)

    def at(k: int, limit: int):
        over, after = (F.coalesce(F.col(f"a{k}.{c}"), F.lit(0)) for c in ("docs_at_least", "tokens_at_least"))
        return F.struct(F.lit(int(limit)).cast("long").alias("context_limit"), over.alias("docs_over"), (F.col("all_tokens") - after + over * int(limit)).alias("truncated_tokens"))

    return one.select(F.inline(F.array(*[at(k, x) for k, x in enumerate(limits)])))


def quantile(sums: DataFrame, q: float) -> DataFrame:
    """The smallest length that at least the share q of the documents do not exceed."""
    return sums.filter(F.col("share_up_to") >= q).agg(F.min("n_tokens").alias("n_tokens"))
