"""Quality classifier: regularised quadratic discriminant analysis of document statistics.

Each text becomes a short vector of transformed statistics (logarithms of sizes, square
roots of shares). Each class gets a Gaussian: its mean and its covariance, shrunk towards
the pooled covariance and towards a multiple of the identity. A document's score is the
posterior of class 1, from the difference of the two Mahalanobis log-densities; the
Cholesky factors are computed once and travel with the model.

Means and covariances are sums over all labelled training rows, formed inside the
partitions and added up by Spark; the driver receives two matrices of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm import words as W
from tradewind.llm.common import id_in, id_out, stored, texts

KINDS = (
    b"abcdefghijklmnopqrstuvwxyz",
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"0123456789",
    b" ",
    b"\n",
    b".,;:!?",
    b"|",
    b"#$%&*@^~=+<>\\/_`{}[]",
    b"'\"-()",
)
N_KINDS = len(KINDS) + 3  # then bytes that begin, that continue a longer character; others
KIND = np.full(256, N_KINDS - 1, np.uint8)
KIND[0x80:0xC0] = N_KINDS - 2
KIND[0xC0:] = N_KINDS - 3
for _i, _bytes in enumerate(KINDS):
    KIND[list(_bytes)] = _i
ALNUM = np.zeros(256, bool)
ALNUM[[*KINDS[0], *KINDS[1], *KINDS[2], *range(0x80, 256)]] = True

#: Added to the sizes that shares are taken of, so that very short texts are no outliers.
FEW_CHARS, FEW_WORDS = 30, 10

FEATURES = (
    "log_chars log_words upper digit newline stop pipe symbol quote wide "
    "word_mean word_spread distinct symbol_end short_word top_word line_mean repeated_line"
).split()


def statistics(batch: pa.RecordBatch) -> np.ndarray:
    """(texts, features) of transformed statistics; an empty text has zeros."""
    data, offsets = W.flat(batch.column(batch.schema.get_field_index("text")))
    n_texts = len(offsets) - 1
    sizes = np.diff(offsets)
    text = np.repeat(np.arange(n_texts, dtype=np.int64), sizes)
    kinds = np.bincount(text * N_KINDS + KIND[data], minlength=n_texts * N_KINDS)
    kinds = kinds.reshape(n_texts, N_KINDS).astype(float)
    chars = sizes - kinds[:, N_KINDS - 2]
    share = np.sqrt(kinds / (chars + FEW_CHARS)[:, None])

    starts, ends, first = W.word_spans(data, offsets)
    n_words = np.diff(first).astype(float)
    lengths = (ends - starts).astype(float)
    of = np.repeat(np.arange(n_texts), np.diff(first))
    per = np.maximum(n_words, 1)
    mean = np.bincount(of, lengths, n_texts) / per
    spread = np.sqrt(np.maximum(np.bincount(of, lengths**2, n_texts) / per - mean**2, 0))
    odd_end = np.bincount(of, ~ALNUM[data[ends - 1]] & (KIND[data[ends - 1]] != 5), n_texts) / per
    short = np.bincount(of, lengths <= 3, n_texts) / per
    hashes = W.spans_hash(W.lowered(data), starts, ends)
    distinct, top = np.zeros(n_texts), np.zeros(n_texts)
    for i in np.flatnonzero(n_words):
        _, counts = np.unique(hashes[first[i] : first[i + 1]], return_counts=True)
        distinct[i], top[i] = len(counts), counts.max()

    breaks = np.flatnonzero(data == 10)
    edges = np.unique(np.concatenate([offsets[:-1][sizes > 0], breaks + 1]))
    edges = edges[edges < len(data)]
    line_ends = np.append(edges[1:], len(data))
    line_hash = W.spans_hash(data, edges, line_ends) if len(edges) else np.zeros(0, np.uint64)
    line_first = np.searchsorted(edges, offsets)
    repeated = np.zeros(n_texts)
    for i in np.flatnonzero(np.diff(line_first) > 1):
        own = line_hash[line_first[i] : line_first[i + 1]]
        repeated[i] = 1 - len(np.unique(own)) / len(own)

    odd_end, short, top = (x / (n_words + FEW_WORDS) for x in (odd_end * per, short * per, top))
    out = np.column_stack(
        [
            np.log1p(chars), np.log1p(n_words), share[:, 1], share[:, 2], share[:, 4], share[:, 5],
            share[:, 6], share[:, 7], share[:, 8], share[:, 9], np.log1p((mean * n_words + 6 * FEW_WORDS) / (n_words + FEW_WORDS)), np.log1p(spread),
            (distinct + FEW_WORDS) / (per + FEW_WORDS) ** 0.85, np.sqrt(odd_end), np.sqrt(short), np.sqrt(top),
            np.log1p(chars / np.maximum(np.diff(line_first), 1)), np.sqrt(repeated),
        ]
    )
    out[sizes == 0] = 0
    return out


def document_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, stats) for every row; only these small vectors are used from here on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in W.slices(whole):
                rows = list(statistics(batch))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "stats"]
                )

    return stored(texts(docs).mapInArrow(run, "doc_id long, stats array<double>"), "quality-stats")


def held_out(column: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(id_out(column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


@dataclass(frozen=True)
class QualityModel:
    """Means, Cholesky factors of the shrunk covariances, and log priors of both classes."""

    means: np.ndarray
    factors: np.ndarray
    log_prior: np.ndarray
    log_det: np.ndarray

    @staticmethod
    def of(counts: np.ndarray, sums: np.ndarray, squares: np.ndarray, to_pooled: float, to_identity: float) -> QualityModel:
        """From (2,) counts, (2, d) sums and (2, d, d) sums of outer products.

        A class without rows takes the other's Gaussian, or the unit Gaussian if neither
        has any, so scores are then the (smoothed) prior.
        """
        d = sums.shape[1]
        seen = np.maximum(counts, 1)
        means = sums / seen[:, None]
        scatter = squares - counts[:, None, None] * np.einsum("ki,kj->kij", means, means)
        pooled = scatter.sum(0) / max(1, counts.sum() - 2)
        covs = []
        for k in (0, 1):
            own = (1 - to_pooled) * scatter[k] / max(1, counts[k] - 1) + to_pooled * pooled
            own = (1 - to_identity) * own + to_identity * np.eye(d) * max(np.trace(own) / d, 1e-3)
            covs.append(own if counts[k] else np.eye(d))
        for k in (0, 1):
            if not counts[k]:
                means[k], covs[k] = means[1 - k], covs[1 - k]
        factors = np.linalg.cholesky(np.stack(covs))
        log_det = np.log(np.diagonal(factors, axis1=1, axis2=2)).sum(1)
        prior = (counts + 1) / (counts.sum() + 2)
        return QualityModel(means, factors, np.log(prior), log_det)

    def scores(self, x: np.ndarray) -> np.ndarray:
        log_density = []
        for k in (0, 1):
            z = np.linalg.solve(self.factors[k], (x - self.means[k]).T)
            log_density.append(self.log_prior[k] - self.log_det[k] - 0.5 * (z**2).sum(0))
        gap = np.clip(log_density[1] - log_density[0], -600, 600)
        return 1 / (1 + np.exp(-gap))


def fit_quality(
    stats: DataFrame, labels: DataFrame, to_pooled: float = 0.1, to_identity: float = 0.01
) -> QualityModel:
    """From all labelled rows that are not held out; rows with a null label do not count."""
    d = len(FEATURES)
    train = stats.where(~held_out()).join(
        labels.where("quality IS NOT NULL").select(
            id_in().alias("doc_id"), F.col("quality").cast("int").alias("label")
        ),
        "doc_id",
    )

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
                label = batch.column(1).to_numpy(zero_copy_only=False)
                for k in (0, 1):
                    own = x[label == k]
                    total[k] += np.concatenate([[len(own)], own.sum(0), (own.T @ own).ravel()])
        yield pa.RecordBatch.from_arrays(
            [pa.array([0, 1], pa.int32()), pa.array(list(total), pa.list_(pa.float64()))],
            ["label", "total"],
        )

    summed = (
        train.select("stats", "label")
        .mapInArrow(moments, "label int, total array<double>")
        .select("label", F.posexplode("total").alias("place", "value"))
        .groupBy("label", "place")
        .agg(F.sum("value").alias("value"))
        .collect()
    )
    total = np.zeros((2, 1 + d + d * d))
    for row in summed:
        total[row["label"], row["place"]] = row["value"]
    return QualityModel.of(
        total[:, 0], total[:, 1 : 1 + d], total[:, 1 + d :].reshape(2, d, d), to_pooled, to_identity
    )


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of docs.

    Labels serve the fit only, and only those of rows that are not held out. Empty and null
    texts are scored too, by their (zero) statistics. Repeated rows get equal scores.
    """
    stats = document_statistics(docs)
    model = fit_quality(stats, labels)
    d = len(FEATURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            scores = model.scores(x) if len(x) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], ["doc_id", "score"])

    return stats.mapInArrow(run, "doc_id long, score double").select(
        id_out("doc_id").alias("doc_id"),
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that are predicted 1, with all their columns, in one pass."""
    model = fit_quality(document_statistics(docs), labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            at = whole.schema.get_field_index("text")
            text = pa.RecordBatch.from_arrays([whole.column(at).fill_null("")], ["text"])
            begin = 0
            for batch in W.slices(text):
                keep = model.scores(statistics(batch)) >= 0.5
                yield whole.slice(begin, batch.num_rows).filter(pa.array(keep))
                begin += batch.num_rows

    return docs.mapInArrow(run, docs.schema)
