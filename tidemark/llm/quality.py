"""Quality classifier by positive-unlabelled learning with the non-negative risk estimator.

Trusted positives are labelled rows of quality 1 in the training folds; unlabelled are any documents of the training
folds, their labels unseen.  The class prior is estimated from the two samples, and an additive model over binned text
statistics minimises the non-negative unbiased risk of Kiryo et al.: prior * E_P[l(g)] + max(0, E_U[l(-g)] - prior *
E_P[l(-g)]).  Labels, language, source and ids are no inputs.

Plan.  One pass over the texts makes their statistics, which are written; all that follows reads these 88 bytes a
document.  At most `sample` trusted positives (those with the smallest hash of the id), one row for each id, are fitted;
that bound is a parameter.  The unlabelled side is every document of the training folds: the cut points come from
counts of all of them, the risk and its gradient are summed over all of them, and so are the tails that give the prior
and the curve that calibrates scores.  A sample of the unlabelled, of the same bound, only gives the start of the
descent and its curvature.  What reaches the driver are sums of bounded length, added up in the cluster, and the samples.

Small samples.  The number of intervals of a statistic is a 50th of the number of positives, between 4 and 16, so below
800 positives the model is coarser.  The prior is widened by its error, which for a few texts makes it nearly one.

Cases.  Null and empty texts, and texts of white space only, score 0.  Texts of any length count whole.  Without any
trusted positive nothing can be learnt and every other text scores 0.5.  A null id counts as the empty text in the fold.
Labels that are null, or of ids without a document, are ignored; labels may repeat.  Of documents that repeat an id, one
(with the smallest hash of the text) can be a trusted positive, and all are unlabelled; ties of that hash are equal texts
and change nothing.  An empty table gives an empty result.  Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import dataclasses
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import dropped, map_arrow, ship, staged

_UPPER, _DIGIT = slice(65, 91), slice(48, 58)
_LOWER = slice(97, 123)
_STOPS, _MARKS = np.frombuffer(b".,;:", np.uint8), np.frombuffer(b"#$%&*|!@^~<>_=+{}[]\\/", np.uint8)
_PLAIN_ENDS = frozenset(b".,;:!?\"')-" + bytes(range(48, 58)) + bytes(range(65, 91)) + bytes(range(97, 123)))

#: Names of the statistics, in order.
FEATURES = (
    "words length upper digits marks stops newlines other_bytes types_to_words top_word adjacent_repeats repeated_triples repeated_lines odd_ends"
    " bare_marks short_words capitalised shouted longest_word words_a_stop entropy top_five_words"
).split()


def text_statistics(text: str | None) -> np.ndarray:
    """Statistics of a whole text; zeros for one without words."""
    raw = (text or "").encode()
    words = raw.split()
    n, w = len(raw), len(words)
    if not w:
        return np.zeros(len(FEATURES), np.float32)
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, lower = int(count[_UPPER].sum()), int(count[_LOWER].sum())
    seen = Counter(words)
    top = seen.most_common(5)
    repeats = sum(map(bytes.__eq__, words, words[1:])) if w > 1 else 0
    triples = len(set(zip(words, words[1:], words[2:], strict=False))) if w > 2 else 0
    lines = [x for x in raw.split(b"\n") if x]
    odd = bare = short = shouted = capital = longest = 0
    for word, times in seen.items():
        size = len(word)
        longest = max(longest, size)
        short += times * (size <= 3)
        if word[-1] < 128 and word[-1] not in _PLAIN_ENDS:
            odd += times
            bare += times * (not word.isalnum() and size == 1)
        capital += times * (65 <= word[0] <= 90)
        shouted += times * (size > 1 and word.isupper())
    share = count[count > 0] / n
    stops = int(count[_STOPS].sum())
    return np.array(
        [
            np.log1p(w),
            np.log1p((n - (w - 1)) / w),
            upper / max(upper + lower, 1),
            count[_DIGIT].sum() / n,
            count[_MARKS].sum() / n,
            stops / n,
            count[10] / n,
            count[128:].sum() / n,
            np.log1p(len(seen)) / np.log1p(w),
            top[0][1] / w,
            repeats / max(w - 1, 1),
            1 - triples / (w - 2) if w > 2 else 0,
            1 - len(set(lines)) / max(len(lines), 1),
            odd / w,
            bare / w,
            short / w,
            capital / w,
            shouted / w,
            np.log1p(longest),
            np.log1p(w / max(stops, 1)),
            -(share * np.log2(share)).sum(),
            sum(k for _, k in top) / w,
        ],
        np.float32,
    )


@dataclasses.dataclass(frozen=True)
class QualityModel:
    """Cut points of each statistic, a weight for each interval, a constant; the estimated prior; and the curve from
    scores to chances."""

    cuts: list[np.ndarray]
    weights: list[np.ndarray]
    constant: float
    prior: float
    curve_at: np.ndarray
    curve: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        g = np.full(len(x), self.constant)
        for k, (cut, weight) in enumerate(zip(self.cuts, self.weights, strict=True)):
            g += weight[np.searchsorted(cut, x[:, k], side="right")]
        # the curve has level parts; a little of the score itself keeps the order there
        return 0.98 * np.interp(g, self.curve_at, self.curve) + 0.02 * _sigmoid(g)


def _descend(gradient: Callable[[np.ndarray], np.ndarray], size: int, steps: int, rate: float) -> np.ndarray:
    """Adam, in single precision: a double would copy the design at every step."""
    w, m, v = (np.zeros(size, np.float32) for _ in range(3))
    for t in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= np.float32(rate) * (m / np.float32(1 - 0.9**t)) / (np.sqrt(v / np.float32(1 - 0.999**t)) + np.float32(1e-8))
    return w


def _sigmoid(g: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(g, -30, 30)))


# Scores are counted in cells of a fixed grid, so that counts of any number of documents are of one length.
_GRID, _REACH = 64, 30
CELLS = 2 * _REACH * _GRID + 1
CENTRES = (np.arange(CELLS) - _REACH * _GRID) / _GRID


def cells(scores: np.ndarray) -> np.ndarray:
    """How many scores fall into each cell."""
    return np.bincount(np.rint((np.clip(scores, -_REACH, _REACH) + _REACH) * _GRID).astype(np.int64), minlength=CELLS).astype(float)


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of positives among the unlabelled, from the cells of a positive-against-unlabelled classifier's scores.

    The smallest ratio of the two tails' masses bounds the share from above, and meets it where no negative scores as
    high; tails with fewer than a tenth of the positives are too noisy, and each ratio is widened by its error.
    """
    n, m = max(positive.sum(), 1), max(unlabelled.sum(), 1)
    p, u = (np.cumsum(x[::-1])[::-1] / k for x, k in ((positive, n), (unlabelled, m)))
    at = p >= 0.1
    error = np.sqrt(u * (1 - u) / m + p * (1 - p) / n) + 0.5 / n + 0.5 / m
    return float(np.clip(((u + error)[at] / p[at]).min(initial=1.0), 0.01, 0.99))


def posterior_by_score(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Points of a rising curve from scores to the chance of a positive, prior * density among positives / density
    among unlabelled, from the cells of both: isotonic regression by pooling adjacent violators."""
    mass = prior * positive / max(positive.sum(), 1)
    weight = mass + unlabelled / max(unlabelled.sum(), 1)
    blocks: list[list[float]] = []
    for k in np.flatnonzero(weight):
        blocks.append([mass[k], weight[k], CENTRES[k] * weight[k]])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [x + y for x, y in zip(blocks[-1], last, strict=True)]
    if not blocks:
        return np.zeros(1), np.full(1, 0.5)
    at, share = np.array([b[2] / b[1] for b in blocks]), np.array([b[0] / b[1] for b in blocks])
    return at, np.clip(share / np.maximum(1 - share, 1e-9), 0, 1)


#: Work on a slice of the unlabelled: (statistics, half that each belongs to) -> a vector that is to be summed.
Work = Callable[[np.ndarray, np.ndarray], np.ndarray]


def local_sums(unlabelled: np.ndarray) -> Callable[[Work], np.ndarray]:
    return lambda work: work(unlabelled, np.arange(len(unlabelled)) % 2)


# Statistics are counted by the leading 18 bits of their single-precision form, an order-preserving number.
_KEY_BITS = 18


def _keys(x: np.ndarray) -> np.ndarray:
    bits = np.ascontiguousarray(x, np.float32).view(np.int32).astype(np.int64)
    return ((bits ^ ((bits >> 31) & 0x7FFFFFFF)) >> (32 - _KEY_BITS)) + (1 << (_KEY_BITS - 1))


def _values_of(keys: np.ndarray) -> np.ndarray:
    bits = ((keys - (1 << (_KEY_BITS - 1))) << (32 - _KEY_BITS)).astype(np.int32)
    return (bits ^ ((bits >> 31) & 0x7FFFFFFF)).view(np.float32)


def _counted(x: np.ndarray, _: np.ndarray) -> np.ndarray:
    """Work: counts of the keys of all statistics, as one long vector."""
    codes = _keys(x) + (np.arange(x.shape[1]) << _KEY_BITS)
    return np.bincount(codes.ravel(), minlength=x.shape[1] << _KEY_BITS).astype(np.float32)


def cut_points(counts: np.ndarray, bins: int) -> list[np.ndarray]:
    """For each statistic: even shares of the unlabelled, and their outer shares."""
    cuts, shares = [], np.concatenate([np.linspace(0, 1, bins + 1)[1:-1], [0.005, 0.01, 0.02, 0.98, 0.99, 0.995]])
    for own in counts.reshape(len(FEATURES), -1):
        at = np.flatnonzero(own)
        rank = np.searchsorted(np.cumsum(own[at]), shares * own.sum())
        cuts.append(np.unique(_values_of(at[np.minimum(rank, len(at) - 1)])) if len(at) else np.empty(0, np.float32))
    return cuts


def _against(p: np.ndarray, u: np.ndarray, decay: float) -> np.ndarray:
    """Plain logistic regression of positive against unlabelled."""
    n, m = max(len(p), 1), max(len(u), 1)
    return _descend(lambda w: -p.T @ (1 - _sigmoid(p @ w)) / n + u.T @ _sigmoid(u @ w) / m + decay * w, p.shape[1], 200, 0.05)


def _risk(p: np.ndarray, w: np.ndarray, prior: float, decay: float, loss: float, slope: np.ndarray) -> tuple[float, np.ndarray]:
    """The negatives' risk and the direction of descent of the non-negative risk with the logistic loss.

    loss, slope: the unlabelled's mean loss as negatives, and its gradient.
    """
    zp, n = p @ w, max(len(p), 1)
    negative = loss - prior * np.logaddexp(0, zp).sum() / n
    up = slope - prior * (p.T @ _sigmoid(zp)) / n
    if negative < 0:  # the estimate of the negatives' risk has left its range: step back out
        return negative, -up
    return negative, prior * (-(p.T @ (1 - _sigmoid(zp))) / n) + up + decay * w


def _non_negative(p: np.ndarray, u: np.ndarray, prior: float, steps: int, decay: float) -> np.ndarray:
    """Minimise the non-negative risk on two samples."""

    def gradient(w: np.ndarray) -> np.ndarray:
        zu, m = u @ w, max(len(u), 1)
        return _risk(p, w, prior, decay, np.logaddexp(0, zu).sum() / m, u.T @ _sigmoid(zu) / m)[1]

    return _descend(gradient, p.shape[1], steps, 0.05)


class _Binned:
    """Statistics as intervals of an additive model."""

    def __init__(self, cuts: list[np.ndarray]) -> None:
        self.cuts = cuts
        self.starts = np.cumsum([0, *(len(c) + 1 for c in cuts)])
        self.size = int(self.starts[-1]) + 1  # and a constant

    def columns(self, x: np.ndarray) -> np.ndarray:
        found = [np.searchsorted(c, x[:, k], side="right") + s for k, (c, s) in enumerate(zip(self.cuts, self.starts, strict=False))]
        return np.stack([*found, np.full(len(x), self.size - 1)], axis=1)

    def design(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), self.size), np.float32)
        np.put_along_axis(out, self.columns(x), 1, axis=1)
        return out


def _sums_of_risk(binned: _Binned, models: list[tuple[np.ndarray, int | None]]) -> Work:
    """Work: for each model (weights, half or None for all) the number, the loss as negatives and its gradient."""

    def work(x: np.ndarray, half: np.ndarray) -> np.ndarray:
        at, out = binned.columns(x), []
        for w, of in models:
            own = at if of is None else at[half == of]
            z = w[own].sum(axis=1)
            slope = np.bincount(own.ravel(), np.repeat(_sigmoid(z), own.shape[1]), binned.size)
            out += [[len(own), np.logaddexp(0, z).sum()], slope]
        return np.concatenate(out)

    return work


def _cells_of_halves(binned: _Binned, by_half: list[np.ndarray]) -> Work:
    """Work: cells of the scores, each by the model of the half that the text isn't in."""

    def work(x: np.ndarray, half: np.ndarray) -> np.ndarray:
        at = binned.columns(x)
        return sum(cells(by_half[h][at[half != h]].sum(axis=1)) for h in (0, 1))

    return work


def fit_quality(
    positive: np.ndarray,
    unlabelled: np.ndarray,
    sums: Callable[[Work], np.ndarray] | None = None,
    bins: int = 16,
    steps: int = 400,
    decay: float = 1e-3,
    passes: int = 6,
) -> QualityModel:
    """Fit on the statistics of trusted positives and of unlabelled texts.

    unlabelled: a sample; sums: sums a Work over all unlabelled texts (the sample alone, if not given).
    """
    sums = sums or local_sums(unlabelled)
    binned = _Binned(cut_points(sums(_counted), int(np.clip(len(positive) // 50, 4, bins))))
    p, u = binned.design(positive), binned.design(unlabelled)

    def refined(starts: list[tuple[np.ndarray, int | None]], prior: float) -> list[np.ndarray]:
        """Newton's steps on the risk over all unlabelled texts; the curvature is that of the sample at the start."""
        found, curves = [w.astype(float) for w, _ in starts], []
        for w, of in starts:
            own = u if of is None else u[of::2]
            s = _sigmoid(own @ w)
            curves.append(np.linalg.inv((own * (s * (1 - s))[:, None]).T.astype(float) @ own / max(len(own), 1) + (decay + 1e-3) * np.eye(binned.size)))
        for _ in range(passes):
            parts = np.split(sums(_sums_of_risk(binned, [(w, of) for w, (_, of) in zip(found, starts, strict=True)])), len(starts))
            for k, ((_, of), part) in enumerate(zip(starts, parts, strict=True)):
                n = max(part[0], 1)
                _, slope = _risk(p if of is None else p[of::2], found[k], prior, decay, part[1] / n, part[2:] / n)
                step = curves[k] @ slope
                found[k] -= step * min(1.0, 0.5 / max(np.abs(step).max(), 1e-9))
        return found

    def of_halves(by_half: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Cells of the scores of both samples, by the model of the other half."""
        return sum(cells(p[1 - h :: 2] @ by_half[h]) for h in (0, 1)), sums(_cells_of_halves(binned, by_half))

    prior = estimate_prior(*of_halves([_against(p[h::2], u[h::2], decay) for h in (0, 1)]))
    starts = [(_non_negative(p, u, prior, steps, decay), None), *((_non_negative(p[h::2], u[h::2], prior, steps, decay), h) for h in (0, 1))]
    w, *by_half = refined(starts, prior)
    levels = posterior_by_score(*of_halves(by_half), prior)
    return QualityModel(binned.cuts, [w[s : s + len(c) + 1] for s, c in zip(binned.starts, binned.cuts, strict=False)], float(w[-1]), prior, *levels)


def held_out(id_column: Column) -> Column:
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _featured(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, held_out, key (a hash of the text) and x, the statistics: written."""
    text, id_ = F.col(f"`{text_col}`"), F.col(f"`{id_col}`")
    chosen = docs.select(text.alias("text"), id_.alias("id"), held_out(id_).alias("held_out"), F.xxhash64(text).alias("key"))
    schema = T.StructType([*(chosen.schema[c] for c in ("id", "held_out", "key")), T.StructField("x", T.BinaryType())])

    def each() -> Callable:
        def work(batch: pa.RecordBatch) -> dict:
            made = [text_statistics(t).tobytes() for t in batch["text"].to_pylist()]
            return {c: batch[c] for c in ("id", "held_out", "key")} | {"x": pa.array(made, pa.binary())}

        return work

    return staged(map_arrow(chosen, each, schema, 256), "quality-features")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(-1, len(FEATURES))


def spark_sums(rows: DataFrame) -> Callable[[Work], np.ndarray]:
    """Sums of a Work over rows (key, x), added up in the cluster: the driver gets one vector."""
    ship(rows.sparkSession)

    def sums(work: Work) -> np.ndarray:
        length = len(work(np.zeros((0, len(FEATURES)), np.float32), np.zeros(0, np.int64)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(length)
            for batch in batches:
                if batch.num_rows:
                    total += work(_matrix(batch["x"]), batch["key"].to_numpy() % 2)
            at = np.flatnonzero(total)
            for low in range(0, len(at), 50_000):
                part = at[low : low + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], ["k", "v"])

        found = rows.select("key", "x").mapInArrow(run, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).toArrow()
        out = np.zeros(length)
        out[found["k"].to_numpy()] = found["v"].to_numpy()
        return out

    return sums


def _train(features: DataFrame, labels: DataFrame, sample: int, id_col: str, label_col: str) -> QualityModel | None:
    trusted = labels.where((F.col(label_col) == 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id")).where(~held_out(F.col("id"))).distinct()
    training = features.where("id is not null and not held_out").select("id", "key", "x")
    order = F.xxhash64("id"), F.col("id")

    def of(ids: DataFrame) -> np.ndarray:
        """One row of statistics for each of at most `sample` ids, in their order."""
        # the ids are at most `sample` rows: broadcast by a proven bound
        few = F.broadcast(ids.orderBy(*order).limit(sample))
        rows = training.join(few, "id", "left_semi").groupBy("id").agg(F.min(F.struct("key", "x")).alias("one"))
        return _matrix(rows.orderBy(*order).select("one.x").toArrow()["x"])

    positive = of(trusted.join(training.select("id").distinct(), "id", "left_semi"))
    if not len(positive):
        return None
    return fit_quality(positive, of(training.select("id").distinct()), spark_sums(training))


def train_quality(docs: DataFrame, labels: DataFrame, sample: int = 8_000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> QualityModel | None:
    """Fit on at most `sample` trusted positives and all unlabelled documents; None without positives."""
    return _train(_featured(docs, id_col, text_col), labels, sample, id_col, label_col)


def _scored(model: QualityModel | None, x: np.ndarray) -> np.ndarray:
    scores = model.score(x) if model else np.full(len(x), 0.5)
    return np.where(x[:, 0] > 0, scores, 0.0)


def score_texts(model: QualityModel | None, texts: list[str | None]) -> np.ndarray:
    return _scored(model, np.array([text_statistics(t) for t in texts], np.float32).reshape(-1, len(FEATURES)))


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = 0.3,
    sample: int = 8_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> DataFrame:
    """One row per document: id, held_out, score, predicted."""
    features = _featured(docs, id_col, text_col)
    model = _train(features, labels, sample, id_col, label_col)

    def each() -> Callable:
        def work(batch: pa.RecordBatch) -> dict:
            scores = _scored(model, _matrix(batch["x"]))
            return {id_col: batch["id"], "held_out": batch["held_out"], "score": scores, "predicted": (scores >= threshold).astype(np.int32)}

        return work

    kind = docs.schema[id_col].dataType.simpleString()
    return map_arrow(features.select("id", "held_out", "x"), each, f"`{id_col}` {kind}, held_out boolean, score double, predicted int", 10_000)


def keep_quality(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = 0.3,
    sample: int = 8_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> DataFrame:
    """The documents whose score reaches the threshold, with their own columns.

    Their statistics are made a second time for that: a copy of all texts beside the statistics would cost more disk.
    """
    features = _featured(docs, id_col, text_col)
    model = _train(features, labels, sample, id_col, label_col)
    dropped(features)
    columns = docs.columns
    at = columns.index(text_col)

    def each() -> Callable:
        def work(batch: pa.RecordBatch) -> dict:
            keep = pa.array(score_texts(model, batch.column(at).to_pylist()) >= threshold)
            return {c: batch.column(k).filter(keep) for k, c in enumerate(columns)}

        return work

    return map_arrow(docs, each, T.StructType([T.StructField(f.name, f.dataType) for f in docs.schema]), 256)
