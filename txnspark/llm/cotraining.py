"""Quality classifier by co-training of two views.

One logistic regression sees the content of a text (its characters, words and their repetition),
another only what is known about the page (language, source, length, lines). Both are fitted to the
labelled documents; then over ``ROUNDS`` rounds each labels the unlabelled documents of which it is
sure, and the other learns from these too. Views are calibrated on held-out labels and combined by
adding their log odds. The models are fitted by Spark over all labelled and pseudo-labelled rows;
only the calibration uses a bounded sample, ``CALIBRATION_ROWS`` held-out rows.

A document is kept where the combined probability of good quality is at least ``KEEP``. Scoring is
a narrow pass over the documents.

Toxicity is a second target: a logistic regression on hashed words, fitted to all labels. Documents
whose probability of it is at least ``TOXIC`` are not kept by ``kept_documents``. ``scored`` judges
quality in ``keep`` and reports toxicity beside it.

Defined results: null or empty texts and null metadata have features of zero and are scored like
any other. Of several labels of one document the worst counts; null labels and labels without
document are ignored. Without a column ``toxic``, or without both of its classes, nothing is toxic
and its scores are null. Repeated rows and rows without doc_id are scored each for itself. Where the
labels do not hold both classes in both parts, no model can be fitted: scores are null and all
documents are kept. An empty table of documents gives no rows; texts of any length are read whole. Other
columns are not looked at, and kept by ``kept_documents``.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnspark.session import written

ROUNDS = 2
SURE = 0.95
KEEP = 0.5
HELD_OUT = 5
CALIBRATION_ROWS = 20_000
NAMES = 32
TOXIC = 0.5
WORD_BUCKETS = 1 << 18
TELLING = 512
VIEWS = ("text_view", "meta_view")

_WORD = re.compile(r"\w+").findall

FEATURES = "doc_id long, text_view array<float>, meta_view array<float>"
SCORES = "doc_id long, text_score double, meta_score double, score double, keep boolean, toxic_score double"
INPUTS = ("doc_id", "text", "lang", "source", "n_chars")


def text_view(data: bytes) -> np.ndarray:
    """Shares of the printable ASCII characters and of other bytes, and what words repeat."""
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words = data.split()
    size, n_words = max(1, len(data)), max(1, len(words))
    upper, lower = counts[65:91].sum(), counts[97:123].sum()
    more = [
        counts[128:].sum() / size,
        upper / max(1, upper + lower),
        len(set(words)) / n_words,
        sum(map(eq, words, words[1:])) / n_words,
        (size - len(words)) / n_words / 10,
        math.log1p(len(words)) / 10,
    ]
    return np.concatenate([counts[32:127] / size, more]).astype(np.float32)


def meta_view(lang: str | None, source: str | None, n_chars: int | None, n_lines: int) -> np.ndarray:
    """Hashed names, and the size of the page and of its lines."""
    out = np.zeros(2 * NAMES + 3, np.float32)
    for at, name in ((0, lang), (NAMES, source)):
        if name is not None:
            out[at + zlib.crc32(name.encode()) % NAMES] = 1
    size = math.log1p(max(0, n_chars or 0)) / 10
    out[-3:] = size, size * size, math.log1p(max(0, n_chars or 0) / max(1, n_lines)) / 10
    return out


def words_of(text: str | None) -> list[int]:
    """Ascending buckets of a text's words, which are lower-cased runs of letters and digits."""
    return sorted({zlib.crc32(w.encode("utf-8", "surrogatepass")) % WORD_BUCKETS for w in _WORD((text or "").lower())})


def _word_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = pa.array(map(words_of, batch.column("text").to_pylist()), pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([batch.column("label"), words], ["label", "words"])


def _bucket_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many documents of each label a bucket occurs."""
    counts = np.zeros((2, WORD_BUCKETS), np.int64)
    for batch in batches:
        lists = batch.column("words")
        labels = np.repeat(batch.column("label").to_numpy() > 0, lists.value_lengths().to_numpy())
        np.add.at(counts, (labels.astype(int), lists.flatten().to_numpy()), 1)
    some = np.flatnonzero(counts.any(axis=0))
    if len(some):
        columns = [pa.array(some), pa.array(counts[0, some]), pa.array(counts[1, some])]
        yield pa.RecordBatch.from_arrays(columns, ["bucket", "clean", "toxic"])


def telling_buckets(counts: np.ndarray, clean: int, toxic: int) -> np.ndarray:
    """Ascending buckets that stand out most, by the chi-square of bucket, clean and toxic documents."""
    total, has = clean + toxic, counts[:, 1] + counts[:, 2]
    apart = counts[:, 2].astype(float) * clean - counts[:, 1].astype(float) * toxic
    square = apart**2 / np.maximum(1.0, has.astype(float) * (total - has)) * (total / (clean * toxic))
    best = np.lexsort((counts[:, 0], -square))[:TELLING]
    return np.sort(counts[best, 0])


def _views(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    texts, langs, sources, sizes = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in INPUTS[1:])
    text, meta = [], []
    for one, lang, source, size in zip(texts, langs, sources, sizes):
        data = (one or "").encode("utf-8", "surrogatepass")
        text.append(text_view(data))
        meta.append(meta_view(lang, source, size, data.count(b"\n") + 1))
    return np.array(text), np.array(meta)


def _lists(rows: np.ndarray) -> pa.ListArray:
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * (rows.shape[1] if len(rows) else 0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.reshape(-1).astype(np.float32)))


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text, meta = _views(batch)
        ids = batch.column(batch.schema.get_field_index("doc_id"))
        yield pa.RecordBatch.from_arrays([ids, _lists(text), _lists(meta)], ["doc_id", *VIEWS])


def _inputs(docs: DataFrame) -> DataFrame:
    kinds = dict(zip(INPUTS, ("long", "string", "string", "string", "long")))
    return docs.select(*(F.col(c).cast(kinds[c]).alias(c) for c in INPUTS))


class Scorer:
    """Coefficients and calibration of both views; small, and sent with the tasks."""

    def __init__(self, views: list[tuple[np.ndarray, float, float, float]], prior: float):
        self.views, self.prior = views, prior

    def scores(self, batch: pa.RecordBatch) -> np.ndarray:
        """Columns: probabilities of the text view, the metadata view, and both."""
        logits = []
        for rows, (weights, bias, slope, shift) in zip(_views(batch), self.views):
            margin = rows.astype(np.float64) @ weights + bias if len(rows) else np.zeros(0)
            logits.append(slope * margin + shift)
        logits.append(logits[0] + logits[1] - self.prior)
        return 1 / (1 + np.exp(-np.clip(np.array(logits).T, -700, 700)))


def _calibrated(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the log odds, by Newton steps with a slight prior on both."""
    x = np.stack([margins, np.ones_like(margins)], axis=1)
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -700, 700)))
        gradient = x.T @ (p - labels) + 1e-2 * (at - [1.0, 0.0])
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        at = at - step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-9:
            break
    return float(at[0]), float(at[1])


def fitted(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS, sure: float = SURE) -> Scorer | None:
    """The scorer learnt from labels (doc_id, quality); None without both classes."""
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
    known = known.agg(F.min("quality").cast("double").alias("label"))
    features = _inputs(docs).mapInArrow(_feature_batches, FEATURES)
    # merged at every size: labels grow with the input
    rows = written(features.join(known.hint("merge"), "doc_id", "left"), "quality-features", "zstd")
    held_out = F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT)) == 0
    train_label = F.when(~held_out, F.col("label"))
    count = lambda of: F.count_if(of).cast("long")
    sizes = rows.agg(
        *(count(part & (F.col("label") == k)) for part in (held_out, ~held_out) for k in (0, 1))
    ).first()
    if not all(sizes):
        return None
    rows = rows.withColumns({v: array_to_vector(F.col(v)) for v in VIEWS})
    share = min(1.0, CALIBRATION_ROWS / (sizes[0] + sizes[1]))
    held = rows.filter(held_out & F.col("label").isNotNull()).filter(
        F.pmod(F.xxhash64("doc_id", F.lit("calibration")), F.lit(1_000_000)) < share * 1_000_000
    )
    prior = math.log(sizes[3] / sizes[2])

    def fit(view: str, given: F.Column | None):
        label = train_label if given is None else F.coalesce(train_label, given)
        learner = LogisticRegression(featuresCol="view", maxIter=30, regParam=1e-3)
        some = rows.select(F.col(view).alias("view"), label.alias("label")).filter("label IS NOT NULL")
        model = learner.fit(some)
        weights, bias = model.coefficients.toArray(), float(model.intercept)
        sample = held.select(view, "label").collect()
        margins = np.array([r[0].toArray() for r in sample]) @ weights + bias
        return weights, bias, *_calibrated(margins, np.array([r[1] for r in sample]))

    def sure_labels(view: str, model) -> F.Column:
        """Labels of the unlabelled rows of which a model is sure."""
        weights, bias, slope, shift = model
        values = F.array(*(F.lit(float(w)) for w in weights))
        margin = F.aggregate(
            F.zip_with(vector_to_array(F.col(view)), values, lambda x, w: x * w), F.lit(bias), lambda a, x: a + x
        )
        p = 1 / (1 + F.exp(-(slope * margin + shift)))
        return F.when(F.col("label").isNull(), F.when(p >= sure, 1.0).when(p <= 1 - sure, 0.0))

    models = [fit(view, None) for view in VIEWS]
    for _ in range(rounds):
        given = [sure_labels(view, model) for view, model in zip(VIEWS, models)]
        models = [fit(VIEWS[0], given[1]), fit(VIEWS[1], given[0])]
    return Scorer(models, prior)


class ToxicScorer:
    """Telling buckets and their weights; small, and sent with the tasks."""

    def __init__(self, buckets: np.ndarray, weights: np.ndarray, bias: float):
        self.weights, self.bias = dict(zip(buckets.tolist(), weights.tolist())), bias

    def scores(self, texts: list[str | None]) -> np.ndarray:
        margins = [sum(self.weights.get(w, 0.0) for w in words_of(t)) + self.bias for t in texts]
        return 1 / (1 + np.exp(-np.clip(np.array(margins, np.float64), -700, 700)))


def fitted_toxic(docs: DataFrame, labels: DataFrame) -> ToxicScorer | None:
    """The scorer of toxicity learnt from labels (doc_id, toxic); None without both classes."""
    if "toxic" not in labels.columns:
        return None
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id")
    known = known.agg(F.max("toxic").cast("double").alias("label"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(known.hint("merge"), "doc_id")
    rows = texts.select("label", "text").mapInArrow(_word_batches, "label double, words array<int>")
    rows = written(rows, "toxic-words", "zstd")
    clean, toxic = rows.agg(F.count_if(F.col("label") == 0), F.count_if(F.col("label") > 0)).first()
    if not clean or not toxic:
        return None
    counts = rows.mapInArrow(_bucket_counts, "bucket long, clean long, toxic long")
    counts = counts.groupBy("bucket").agg(F.sum("clean"), F.sum("toxic")).toArrow()
    buckets = telling_buckets(np.array([c.to_numpy() for c in counts.columns]).T, clean, toxic)

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("words")
            row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
            words = lists.flatten().to_numpy()
            at = np.minimum(np.searchsorted(buckets, words), len(buckets) - 1)
            hit = buckets[at] == words
            out = np.zeros((len(lists), len(buckets)), np.float32)
            out[row[hit], at[hit]] = 1
            yield pa.RecordBatch.from_arrays([batch.column("label"), _lists(out)], ["label", "view"])

    vectors = rows.mapInArrow(present, "label double, view array<float>")
    vectors = written(vectors, "toxic-view", "zstd").select("label", array_to_vector("view").alias("view"))
    # on the plain scale of 0 and 1 a word of few documents cannot weigh as much as one of many
    learner = LogisticRegression(featuresCol="view", maxIter=50, regParam=1e-4, standardization=False)
    model = learner.fit(vectors)
    return ToxicScorer(buckets, model.coefficients.toArray(), float(model.intercept))


def scored(docs: DataFrame, labels: DataFrame, keep: float = KEEP) -> DataFrame:
    """One row per document: doc_id, text_score, meta_score, score, keep, toxic_score."""
    scorer, toxic = fitted(docs, labels), fitted_toxic(docs, labels)
    if scorer is None and toxic is None:
        none = (F.lit(None).cast("double").alias(c) for c in ("text_score", "meta_score", "score"))
        return docs.select(F.col("doc_id").cast("long"), *none, F.lit(True).alias("keep"), F.lit(None).cast("double").alias("toxic_score"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nothing = pa.nulls(len(batch), pa.float64())
            quality = [nothing] * 3 if scorer is None else [pa.array(c) for c in scorer.scores(batch).T]
            keeps = np.ones(len(batch), bool) if scorer is None else quality[2].to_numpy() >= keep
            bad = nothing if toxic is None else pa.array(toxic.scores(batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *quality, pa.array(keeps), bad],
                ["doc_id", "text_score", "meta_score", "score", "keep", "toxic_score"],
            )

    return _inputs(docs).mapInArrow(run, SCORES)


def kept_documents(docs: DataFrame, labels: DataFrame, keep: float = KEEP) -> DataFrame:
    """The rows of ``docs`` whose quality suffices and that are not toxic, with all their columns."""
    scorer, toxic = fitted(docs, labels), fitted_toxic(docs, labels)
    if scorer is None and toxic is None:
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = np.ones(len(batch), bool) if scorer is None else scorer.scores(batch)[:, 2] >= keep
            if toxic is not None:
                texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
                kept &= toxic.scores(texts) < TOXIC
            yield batch.filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)
