"""Hashed n-gram features of texts and their counts by class."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import row_slices, shingle_hashes, word_hashes, word_spans


def features(column: pa.Array, buckets: int, order: int = 2):
    """Yield ``first row, rows, buckets, number of words by row`` for runs of rows of a text column.

    Features are all word n-grams up to ``order``, A-Z lower-cased, repeats included.
    """
    for at, raw, offsets in row_slices(column):
        starts, ends, rows = word_spans(raw, offsets)
        words = word_hashes(raw, starts, ends)
        owner, bucket = [rows], [words % np.uint64(buckets)]
        for n in range(2, order + 1):
            hashes, first = shingle_hashes(words, rows, n)
            owner.append(rows[first])
            bucket.append(hashes % np.uint64(buckets))
        yield at, np.concatenate(owner), np.concatenate(bucket).astype(np.int64), np.bincount(rows, minlength=len(offsets) - 1)


def bounded_sample(labelled: DataFrame, per_class: int) -> DataFrame:
    """At most ``per_class`` rows ``doc_id``, ``class`` of each class, those with the smallest hash of the id.

    ``class`` counts from 0. An id with several classes takes the smallest.
    Null ids and classes are left out.
    """
    clean = labelled.where("doc_id is not null and class is not null").groupBy("doc_id").agg(F.min("class").alias("class"))
    found = [r["class"] for r in clean.select("class").distinct().collect()]
    parts = [clean.where(F.col("class") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in found]
    out = clean.limit(0)
    for p in parts:
        out = out.union(p)
    return out


def class_counts(docs: DataFrame, sample: DataFrame, classes: int, buckets: int, order: int, everything: bool) -> np.ndarray:
    """Feature counts, one row a class and one column a bucket.

    ``docs`` has ``doc_id`` and ``text``; ``sample`` is a bounded table of
    ``doc_id`` and ``class``, sent to every task. See ``marked_counts``.
    """
    return marked_counts(docs.join(F.broadcast(sample), "doc_id", "left" if everything else "inner"), classes, buckets, order, everything)


def marked_counts(marked: DataFrame, classes: int, buckets: int, order: int, everything: bool) -> np.ndarray:
    """Feature counts, one row a class and one column a bucket, of a table with ``text`` and ``class`` (may be null).

    With ``everything`` one more row has the counts over all documents. Each
    task adds up its own counts before they are shuffled.
    """
    joined = marked.select("text", "class")
    rows = classes + everything

    def run(batches):
        total = np.zeros((rows, buckets), np.int64)
        for batch in batches:
            kind = batch.column(1).fill_null(-1).to_numpy()
            for at, row, bucket, words in features(batch.column(0), buckets, order):
                if everything:
                    total[classes] += np.bincount(bucket, minlength=buckets)
                mine = kind[at + row]
                for c in np.unique(mine[mine >= 0]):
                    total[c] += np.bincount(bucket[mine == c], minlength=buckets)
        used = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(total[r, used]) for r in range(rows))],
                                         names=["bucket", *(f"n{r}" for r in range(rows))])

    schema = "bucket long" + "".join(f", n{r} long" for r in range(rows))
    got = (joined.mapInArrow(run, schema).groupBy("bucket")
           .agg(*(F.sum(f"n{r}").alias(f"n{r}") for r in range(rows))).toArrow())
    out = np.zeros((rows, buckets))
    for r in range(rows):
        out[r, got.column("bucket").to_numpy()] = got.column(f"n{r}").to_numpy()
    return out
