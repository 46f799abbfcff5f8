"""Mixing documents to target token weights with soft domain membership.

A softmax regression on the hashed words that set the domains of a labelled
table apart gives each document a posterior over domains. A document's tokens
count for each domain in proportion. Nonnegative rates, one a document, are then fitted by
accelerated projected gradient so that the expected token totals of the
domains match the targets.

The objective is half the sum over domains of the squared miss, weighted by
one over the domain's share of the tokens. In the metric of token counts the
step of one document is its posterior times the weighted miss, and the step
size one is exact: the curvature matrix has row sums one. So an iteration
needs only the domains' misses: each task works out the rates of its
documents again from the misses so far, and sums expected tokens.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stored
from tessera.llm.hashed import bounded_sample, features


def softmax(logits: np.ndarray) -> np.ndarray:
    p = np.exp(logits - logits.max(axis=1, keepdims=True, initial=-np.inf))
    return p / p.sum(axis=1, keepdims=True)


def fit_softmax(x: np.ndarray, y: np.ndarray, classes: int, penalty: float = 1e-4, steps: int = 200) -> np.ndarray:
    """Weights of a softmax regression with a quadratic penalty, by accelerated gradient descent."""
    x = x.astype(np.float32)
    v = np.ones(x.shape[1], np.float32)
    for _ in range(20):  # the largest curvature, by power iteration
        v = x.T @ (x @ v)
        size = float(np.linalg.norm(v))
        v /= max(size, 1e-12)
    step = np.float32(1 / (0.55 * size / max(1, len(x)) + penalty))
    target = np.eye(classes, dtype=np.float32)[y]
    w = ahead = np.zeros((x.shape[1], classes), np.float32)
    t = 1.0
    for _ in range(steps):
        slope = x.T @ (softmax(x @ ahead) - target) / np.float32(max(1, len(x))) + np.float32(penalty) * ahead
        new = ahead - step * slope
        grown = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + np.float32((t - 1) / grown) * (new - w)
        w, t = new, grown
    return w.astype(float)


def _present(column: pa.Array, buckets: int, number: np.ndarray | None = None):
    """Yield ``first row, rows, buckets, words by row``: the distinct buckets of each row's words.

    With ``number``, buckets are replaced by their numbers and those below 0 left out.
    """
    for at, row, bucket, words in features(column, buckets, 1):
        if number is not None:
            bucket = number[bucket]
            row, bucket = row[bucket >= 0], bucket[bucket >= 0]
        pair = np.unique(row * np.int64(buckets) + bucket)
        yield at, pair // buckets, pair % buckets, words


def _lists(row: np.ndarray, value: np.ndarray, n: int) -> pa.ListArray:
    ends = np.r_[0, np.cumsum(np.bincount(row, minlength=n))].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(value.astype(np.int32)))


def fit_classifier(docs: DataFrame, sample: DataFrame, classes: int, buckets: int, picked: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the picked buckets (-1: not picked) and the weights, one row a bucket, then bias and log length.

    ``sample`` (``doc_id``, ``class``) is bounded and sent to every task. The
    ``picked`` buckets are those whose document frequency in some class is
    farthest from that in all classes, in standard deviations.
    """
    def present(batches):
        for batch in batches:
            for at, row, bucket, words in _present(batch.column(0), buckets):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(at, len(words)), pa.array(words.astype(np.int64)), _lists(row, bucket, len(words))],
                    names=["class", "words", "buckets"])

    rows = stored(docs.join(F.broadcast(sample), "doc_id").select("text", "class")
                  .mapInArrow(present, "class int, words long, buckets array<int>"), "labelled-words")

    def count(batches):
        total = np.zeros((classes, buckets), np.int64)
        for batch in batches:
            kind = np.repeat(batch.column(0).to_numpy(), pa.compute.list_value_length(batch.column(2)).to_numpy())
            total += np.bincount(kind * np.int64(buckets) + batch.column(2).flatten().to_numpy(),
                                 minlength=classes * buckets).reshape(classes, buckets)
        c, b = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(total[c, b])],
                                         names=["c", "b", "n"])

    got = rows.select("class", "words", "buckets").mapInArrow(count, "c int, b int, n long").groupBy("c", "b").agg(
        F.sum("n").alias("n")).toArrow()
    n = np.zeros((classes, buckets))
    n[got.column("c").to_numpy(), got.column("b").to_numpy()] = got.column("n").to_numpy()
    size = np.zeros(classes)
    for r in rows.groupBy("class").count().collect():
        size[r["class"]] = r["count"]
    share = n.sum(axis=0) / max(1.0, size.sum())
    apart = np.abs(n - size[:, None] * share) / np.sqrt(size[:, None] * share * (1 - share) + 1)
    best = np.argsort(-apart.max(axis=0), kind="stable")[:picked]
    number = np.full(buckets, -1, np.int64)
    number[best] = np.arange(len(best))

    def thin(batches):
        for batch in batches:
            width = pa.compute.list_value_length(batch.column(2)).to_numpy()
            row, value = np.repeat(np.arange(len(width)), width), number[batch.column(2).flatten().to_numpy()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _lists(row[value >= 0], value[value >= 0], len(width))],
                                             names=["class", "words", "buckets"])

    table = rows.mapInArrow(thin, "class int, words long, buckets array<int>").toArrow().combine_chunks()
    x = np.zeros((len(table), len(best) + 2), np.float32)
    if len(table):
        lists = table.column("buckets").combine_chunks()
        x[np.repeat(np.arange(len(table)), pa.compute.list_value_length(lists).to_numpy()), lists.flatten().to_numpy()] = 1
    x[:, -2], x[:, -1] = 1, np.log1p(table.column("words").to_numpy())
    weights = fit_softmax(x, table.column("class").to_numpy(), classes)
    weights[-2] -= np.log(np.maximum(size, 0.5) / max(1.0, size.sum()))  # the sample's own priors go
    return number, weights


def posteriors(docs: DataFrame, labelled: DataFrame, buckets: int = 1 << 17, picked: int = 1024, per_domain: int = 4_000
               ) -> tuple[list[str], DataFrame]:
    """Domains and, for each row, ``doc_id``, ``tokens``, ``posterior`` (an array in the order of the domains).

    ``labelled`` has ``doc_id`` and ``domain``. At most ``per_domain`` labelled
    documents of each domain, those with the smallest hash of the id, fit the
    classifier; priors are the shares of all labelled rows. Features are
    whether a document has a word of each of ``picked`` hash buckets, and the
    log of its length. Tokens are white-space words.
    """
    rows = labelled.where("doc_id is not null and domain is not null")
    shares = {r["domain"]: r["count"] for r in rows.groupBy("domain").count().collect()}
    domains = sorted(shares)
    number, weights = np.full(buckets, -1, np.int64), np.zeros((2, len(domains)))
    if domains:
        classes = F.create_map(*[F.lit(x) for i, d in enumerate(domains) for x in (d, i)])
        sample = bounded_sample(rows.select("doc_id", classes[F.col("domain")].alias("class")), per_domain)
        number, weights = fit_classifier(docs, sample, len(domains), buckets, picked)
        weights[-2] += np.log(np.array([shares[d] for d in domains], float) / sum(shares.values()))

    def run(batches):
        for batch in batches:
            tokens, logits = np.zeros(len(batch), np.int64), np.zeros((len(batch), len(domains)))
            for at, row, picks, words in _present(batch.column(1), buckets, number):
                m = len(words)
                tokens[at:at + m] = words
                for d in range(len(domains)):
                    logits[at:at + m, d] = np.bincount(row, weights[picks, d], minlength=m)
            post = softmax(logits + weights[-2] + np.log1p(tokens)[:, None] * weights[-1]) if domains else logits
            ends = np.arange(len(batch) + 1, dtype=np.int32) * len(domains)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(tokens), pa.ListArray.from_arrays(pa.array(ends), pa.array(post.ravel()))],
                names=["doc_id", "tokens", "posterior"])

    return domains, docs.select("doc_id", "text").mapInArrow(run, "doc_id long, tokens long, posterior array<double>")


def replay(p: np.ndarray, misses: list[np.ndarray], start: float) -> tuple[np.ndarray, np.ndarray]:
    """Rates after the steps so far, and the extrapolated point at which the next miss is taken."""
    rate = point = np.full(len(p), start)
    t = 1.0
    for miss in misses:
        new = np.maximum(0.0, point - p @ miss)
        grown = (1 + np.sqrt(1 + 4 * t * t)) / 2
        point = np.maximum(0.0, new + (t - 1) / grown * (new - rate))
        rate, t = new, grown
    return rate, point


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def fit_rates(table: DataFrame, targets: np.ndarray, start: float, tolerance: float = 1e-4, most: int = 60
              ) -> tuple[list[np.ndarray], np.ndarray]:
    """Weighted misses of the steps taken and the expected totals reached.

    ``table`` is the stored table of ``posteriors``; ``targets`` are token
    totals by domain. Stops when no domain misses by more than ``tolerance``
    of all target tokens, or after ``most`` steps.
    """
    width = len(targets)

    def sums(misses, at_point):
        def run(batches):
            got = np.zeros((2, width))
            for batch in batches:
                p, n = _matrix(batch.column(1), width), batch.column(0).to_numpy()
                rate, point = replay(p, misses, start)
                got += np.stack([n @ p, (n * (point if at_point else rate)) @ p])
            yield pa.RecordBatch.from_arrays([pa.array(got[i], pa.float64()) for i in (0, 1)], names=["mass", "expected"]
                                             ).append_column("d", pa.array(range(width), pa.int32()))

        got = (table.select("tokens", "posterior").mapInArrow(run, "mass double, expected double, d int")
               .groupBy("d").agg(F.sum("mass").alias("mass"), F.sum("expected").alias("expected")).collect())
        out = np.zeros((2, width))
        for r in got:
            out[:, r["d"]] = r["mass"], r["expected"]
        return out

    misses: list[np.ndarray] = []
    for _ in range(most):
        mass, expected = sums(misses, True)
        if np.abs(expected - targets).max(initial=0) <= tolerance * targets.sum():
            break
        misses.append((expected - targets) / np.maximum(mass, 1e-9))
    return misses, sums(misses, False)[1]


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], scale: float = 1.0, seed: int = 42,
        doc_id: str = "doc_id", text: str = "text", **model) -> DataFrame:
    """Rates and copies of documents for a mixture with target domain weights.

    ``targets`` are weights by domain (they are scaled to sum to one; a domain
    of the labelled table that is not named gets weight zero). The mixture has
    ``scale`` times the tokens of ``docs``. Returns ``doc_id``, ``tokens``,
    ``posterior``, ``rate``, ``copies``; copies is the rate rounded up or down
    at random, by a hash of the id, with the rate as its expectation.

    Null and empty texts have no tokens; their posterior is that of a text
    without words. Rows that repeat an id get equal rates. Rows with a null id get a rate, too.
    With no labelled rows, or no weight on any of their domains, every rate is
    ``scale``. An empty table gives no rows. Other columns are not read.
    """
    clean = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    domains, table = posteriors(clean, labelled.select("doc_id", "domain"), **model)
    table = stored(table, "posteriors")
    weight = np.array([max(0.0, targets.get(d, 0.0)) for d in domains])
    misses: list[np.ndarray] = []
    total = float(table.agg(F.sum("tokens")).first()[0] or 0)
    if weight.sum() > 0 and total:
        misses, _ = fit_rates(table, weight / weight.sum() * total * scale, scale)
    width = len(domains)

    def run(batches):
        for batch in batches:
            rate, _ = replay(_matrix(batch.column(2), width), misses, scale)
            yield batch.append_column("rate", pa.array(np.round(rate, 9), pa.float64()))

    uniform = F.xxhash64("doc_id", F.lit(seed)) / F.lit(float(1 << 64)) + F.lit(0.5)
    rated = table.mapInArrow(run, "doc_id long, tokens long, posterior array<double>, rate double")
    return rated.withColumn("copies", (F.floor("rate") + (uniform < F.col("rate") - F.floor("rate")).cast("int")).cast("int"))
