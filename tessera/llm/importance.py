"""Importance resampling towards a target text distribution.

Two hashed n-gram models, one of target text and one of all text, give each
document the log of its importance weight. Gumbel noise is added and the k
largest keys are kept, which draws k documents without replacement in
proportion to their weights. The noise is a hash of the id, so a task that
runs again draws the same.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stored
from tessera.llm.hashed import bounded_sample, features, marked_counts
from tessera.operators.joins import checked_broadcast

# Target ids, a long each, that may be sent to every task.
MOST_IDS = 1_000_000


def log_ratios(docs: DataFrame, target: DataFrame, buckets: int = 1 << 18, order: int = 1, target_rows: int | None = None,
               smoothing: float = 1.0) -> DataFrame:
    """``doc_id``, ``ngrams`` (of up to ``order`` words) and ``mean_log_ratio`` (of target over all text, per n-gram) of each row of ``docs``.

    ``target`` has the ids of target documents. The target model is fitted on
    all of them, or on at most ``target_rows``, those with the smallest hash.
    The model of all text counts every n-gram of every document. A document
    that is itself used for the target model is scored without its own counts
    in it. Where the ids are too many to send to every task, the documents are
    joined with them once and written.
    """
    labelled = target.select("doc_id", F.lit(0).alias("class"))
    if target_rows is None:
        fitted = stored(labelled.where("doc_id is not null").distinct(), "target-ids")
    else:
        fitted = stored(bounded_sample(labelled, target_rows), "target-sample")
    fitted, small = checked_broadcast(fitted, MOST_IDS, materialize=False)
    marked = docs.select("doc_id", "text").join(fitted, "doc_id", "left")
    if not small:
        marked = stored(marked, "target-marked", release=True)
    counts = marked_counts(marked, 1, buckets, order, everything=True) + smoothing
    like_target, like_all = counts[0], np.log(counts[1] / counts[1].sum())
    ratio = np.log(like_target / like_target.sum()) - like_all

    def run(batches):
        for batch in batches:
            n, total = np.zeros(len(batch), np.int64), np.zeros(len(batch))
            used = batch.column(2).is_valid().to_numpy(zero_copy_only=False)
            for at, row, bucket, words in features(batch.column(1), buckets, order):
                m = len(words)
                n[at:at + m] = np.bincount(row, minlength=m)
                total[at:at + m] = np.bincount(row, ratio[bucket], minlength=m)
                if used[at:at + m].any():
                    own = used[at:at + m]
                    pair, times = np.unique(row[own[row]] * np.int64(buckets) + bucket[own[row]], return_counts=True)
                    r, b = pair // buckets, pair % buckets
                    rest = np.log(like_target[b] - times) - np.log(like_target.sum() - n[at + r]) - like_all[b]
                    total[at:at + m] = np.where(own, np.bincount(r, times * rest, minlength=m), total[at:at + m])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(total / np.maximum(n, 1))],
                                             names=["doc_id", "ngrams", "mean_log_ratio"])

    return marked.mapInArrow(run, "doc_id long, ngrams long, mean_log_ratio double")


def kth_largest(df: DataFrame, value: str, k: int, bins: int = 1024, small: int = 10_000) -> float:
    """The ``k``-th largest of a column of finite doubles, by counting in ever finer bins."""
    low, high = df.agg(F.min(value), F.max(value)).first()
    while low < high:
        inside = df.where(F.col(value).between(low, high))
        step = (high - low) / bins
        counts = dict(inside.groupBy(F.least(F.floor((F.col(value) - low) / step), F.lit(bins - 1)).alias("bin"))
                      .agg(F.struct(F.count("*").alias("n"), F.min(value).alias("low"), F.max(value).alias("high"))).collect())
        for b in sorted(counts, reverse=True):
            if k <= counts[b]["n"]:
                low, high, n = counts[b]["low"], counts[b]["high"], counts[b]["n"]
                break
            k -= counts[b]["n"]
        if n <= small:
            return sorted((r[0] for r in df.where(F.col(value).between(low, high)).select(value).collect()), reverse=True)[k - 1]
    return low


def gumbel(seed: int):
    """Standard Gumbel noise from a hash of the id."""
    uniform = (F.xxhash64("doc_id", F.lit(seed)) / F.lit(float(1 << 64)) + F.lit(0.5))
    return -F.log(-F.log(F.greatest(F.least(uniform, F.lit(1 - 2.0 ** -53)), F.lit(2.0 ** -53))))


def resample(docs: DataFrame, target: DataFrame, share: float, seed: int = 42, doc_id: str = "doc_id", text: str = "text",
             target_id: str = "doc_id", **model) -> DataFrame:
    """Draw ``round(share * rows)`` documents by Gumbel top-k on their importance weights.

    Returns ``doc_id``, ``log_weight``, ``gumbel_key``, ``selected`` for every
    row with an id. The log weight is the mean log ratio of a document's
    n-grams times the mean number of n-grams of a document, so that length
    alone does not decide.

    Null and empty texts have weight one (log 0). Rows that repeat an id share
    its noise; ties at the k-th key go to the smaller id, rows of one id all
    fall on the same side. Rows with a null id take no part. With no target
    rows all weights follow from the smoothed empty model; an empty table
    gives no rows. Other columns are not read.
    """
    clean = docs.where(F.col(f"`{doc_id}`").isNotNull()).select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    ratios = stored(log_ratios(clean, target.select(F.col(f"`{target_id}`").cast("long").alias("doc_id")), **model),
                    "log-ratios")
    n, mean = ratios.agg(F.count("*"), F.avg("ngrams")).first()
    keyed = (ratios.withColumn("log_weight", F.round(F.col("mean_log_ratio") * float(mean or 0.0), 9))
             .withColumn("gumbel_key", F.col("log_weight") + gumbel(seed)))
    k = round(share * n)
    if not n or k <= 0 or k >= n:
        return keyed.select("doc_id", "log_weight", "gumbel_key", F.lit(bool(n) and k >= n).alias("selected"))
    bound = kth_largest(keyed, "gumbel_key", k)
    above = keyed.where(F.col("gumbel_key") > bound).count()
    tied = [r[0] for r in keyed.where(F.col("gumbel_key") == bound).orderBy("doc_id").limit(k - above).select("doc_id").collect()]
    last = max(tied)
    return keyed.select("doc_id", "log_weight", "gumbel_key",
                        ((F.col("gumbel_key") > bound) | (F.col("gumbel_key") == bound) & (F.col("doc_id") <= last))
                        .alias("selected"))
