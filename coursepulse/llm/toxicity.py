"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word's vector is the sum of its rows in ``HASHES`` embedding tables: one hashed by the word,
the others by its first ``STEMS`` characters, so that inflected and compound forms of a learnt
stem are recognised, and other words share a vector only if they collide in all tables. Training
starts from a prior: the first coordinate of a row is its evidence in the sample (see ``evidence``),
which filters of single words begin by reading. With few labels rare words have little of it, and the
fit does not begin by learning them by heart. Filters of widths ``WIDTHS`` slide over the whole text, each keeps its maximum, and a logistic layer scores the maxima. Only the text is an
input. Labels come from a bounded sample: the ``SAMPLE`` labelled rows of either class that are
first by a hash of their id; every fourth of them takes no part in training. All labelled rows
without part in training are scored, and counted by language, label and score; each class weighs
as much as all its labelled rows, so that what the sample takes from either class does not move
the cut. From these counts a threshold is chosen for each language.

Null and empty texts have no windows and get the score of the bias alone. Labels that are null
or contradict each other (repeated ids) count as toxic if any says so; null ids are ignored.
Without any label every score is 0.5 and nothing is rejected. Long texts are scored whole.
Repeated rows keep their number; further columns are kept, those of an output's name replaced.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

from coursepulse.session import materialize

STEMS = (4, 5, 6)
HASHES, HASH_BITS, DIM = 1 + len(STEMS), 16, 12
WIDTHS, FILTERS = (1, 2, 3), 8
# Bound of the sample: so many rows of either class.
SAMPLE = 2000
EPOCHS, BATCH, RATE = 8, 64, 0.02
EVIDENCE = 0.1  # first coordinate of a table row for each standard error of its log ratio
CALIBRATION = 4  # every fourth id of the sample is not trained on
OUTPUTS = ["score", "threshold", "rejected"]
CUTS = np.linspace(0.05, 0.95, 91)
LEAST = 10  # rows of either class that a language needs for a threshold of its own
PUNCTUATION = ".,;:!?\"'()[]{}<>«»¿¡…-_*#"
BLOCK_CHARS = 1 << 20
BATCH_ROWS = 256  # rows of an Arrow batch that are Python objects at a time
WORD_END = re.compile(r"(?<=\S)\s")


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def pieces(text: str | None, size: int | None = None) -> Iterator[str]:
    """A text in pieces of about ``size`` (BLOCK_CHARS), cut between words.

    A piece begins with the last words of the one before, one less than the widest filter takes,
    so that each window is in a piece.
    """
    text, size, start = text or "", size or BLOCK_CHARS, 0
    while True:
        cut, words = WORD_END.search(text, start + size), []
        while cut:
            words = text[start : cut.start()].rsplit(None, max(WIDTHS) - 1)
            if len(words) == max(WIDTHS):
                break
            cut = WORD_END.search(text, cut.end())
        if not cut:
            yield text[start:]
            return
        yield text[start : cut.start()]
        start += len(words[0])


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), BATCH_ROWS):
            yield batch.slice(at, BATCH_ROWS)


def rows_of(words: list[str]) -> np.ndarray:
    """For each word its row in each table."""
    digest = xxhash.xxh64_intdigest
    bare = [w.strip(PUNCTUATION) or w for w in words]
    mask = (1 << HASH_BITS) - 1
    out = np.empty((len(words), HASHES), dtype=np.int32)
    for table, size in enumerate((None, *STEMS)):
        out[:, table] = np.fromiter(
            ((digest(w[:size], table) & mask) | (table << HASH_BITS) for w in bare),
            dtype=np.int32,
            count=len(words),
        )
    return out


def slots() -> list[tuple[int, int]]:
    """(width, offset) of each block of ``FILTERS`` columns in the filters' matrix."""
    return [(w, k) for w in WIDTHS for k in range(w)]


@dataclass
class Model:
    embed: np.ndarray
    filters: np.ndarray
    inner: np.ndarray
    out: np.ndarray
    bias: float
    thresholds: dict[str | None, float] = field(default_factory=dict)

    @classmethod
    def start(cls, seed: int = 7) -> Model:
        rng = np.random.default_rng(seed)
        wide = len(WIDTHS) * FILTERS
        return cls(
            embed=(rng.normal(0, 0.02, (HASHES << HASH_BITS, DIM))).astype(np.float32),
            filters=rng.normal(0, 0.4, (DIM, len(slots()) * FILTERS)).astype(np.float32),
            inner=np.zeros(wide, np.float32),
            out=rng.normal(0, 0.3, wide).astype(np.float32),
            bias=0.0,
        )

    def pooled(self, parts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Maxima per text and filter, and where they are (-1: no window).

        ``parts`` has for each word its share in each (width, offset) block; texts stand one
        after another, ``lengths`` words each. A text shorter than a filter has no window.
        """
        n = len(lengths)
        ends = np.cumsum(lengths)
        starts = ends - lengths
        best = np.full((n, len(WIDTHS) * FILTERS), 0.0, np.float32)
        where = np.full(best.shape, -1, np.int64)
        at = 0
        for i, width in enumerate(WIDTHS):
            cols = slice(i * FILTERS, (i + 1) * FILTERS)
            blocks = [parts[:, (at + k) * FILTERS : (at + k + 1) * FILTERS] for k in range(width)]
            at += width
            fits = np.flatnonzero(lengths >= width)
            if not len(fits):
                continue
            total = len(parts) - width + 1
            value = blocks[0][:total].copy()
            for k in range(1, width):
                value += blocks[k][k : k + total]
            value += self.inner[cols]
            # Windows that run over a text's end never win.
            over = np.concatenate(
                [ends[:-1] - 1 - j for j in range(width - 1)] or [np.empty(0, np.int64)]
            )
            value[over[(over >= 0) & (over < total)]] = -np.inf
            found = np.maximum.reduceat(value, starts[fits], axis=0)
            best[fits, cols] = np.maximum(found, 0)
            if self.training:
                for row, f in enumerate(fits):
                    span = value[starts[f] : ends[f] - width + 1]
                    where[f, cols] = starts[f] + span.argmax(axis=0)
        where[best <= 0] = -1
        return best, where

    training = False

    def _maxima(self, texts: list[str]) -> np.ndarray:
        """Maxima of each filter; distinct words are embedded and filtered once."""
        local: dict[str, int] = {}
        split = [words_of(x) for x in texts]
        lengths = np.array([len(x) for x in split], dtype=np.int64)
        index = np.fromiter(
            (local.setdefault(w, len(local)) for x in split for w in x), dtype=np.int64
        )
        if not len(index):
            return np.zeros((len(texts), len(WIDTHS) * FILTERS), np.float32)
        shares = self.embed[rows_of(list(local))].sum(axis=1) @ self.filters
        return self.pooled(shares[index], lengths)[0]

    def scores_of(self, texts: list[str | None]) -> np.ndarray:
        """Scores of whole texts, of which about ``BLOCK_CHARS`` are split into words at a time."""
        best = np.zeros((len(texts), len(WIDTHS) * FILTERS), np.float32)
        block, owners, size = [], [], 0
        for i, text in enumerate(texts):
            for piece in pieces(text):
                block.append(piece)
                owners.append(i)
                size += len(piece)
                if size >= BLOCK_CHARS:
                    np.maximum.at(best, owners, self._maxima(block))
                    block, owners, size = [], [], 0
        if block:
            np.maximum.at(best, owners, self._maxima(block))
        return 1 / (1 + np.exp(-(best.astype(np.float64) @ self.out + self.bias)))


class Adam:
    def __init__(self, shape: tuple[int, ...], rate: float) -> None:
        self.m, self.v, self.t, self.rate = np.zeros(shape, np.float32), np.zeros(shape, np.float32), 0, rate

    def step(self, grad: np.ndarray, rows=slice(None)) -> np.ndarray:
        """The change; ``rows`` limits it to those with a gradient."""
        self.t += 1
        self.m[rows] = 0.9 * self.m[rows] + 0.1 * grad
        self.v[rows] = 0.99 * self.v[rows] + 0.01 * grad * grad
        m, v = self.m[rows] / (1 - 0.9**self.t), self.v[rows] / (1 - 0.99**self.t)
        return -self.rate * m / (np.sqrt(v) + 1e-6)


def evidence(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """For each row of the tables how far the texts that hold it tell the labels apart.

    The log ratio of its shares in toxic and in other texts, in standard errors: small for a row
    that few texts hold, zero for one that none does.
    """
    held = np.zeros((2, HASHES << HASH_BITS))
    for words, label in zip(rows, labels, strict=True):
        held[int(label > 0), np.unique(words)] += 1
    texts = np.bincount(np.asarray(labels) > 0, minlength=2)[:, None]
    share = np.log((held + 0.5) / (texts + 1))
    error = np.sqrt((1 / (held + 0.5)).sum(axis=0))
    return np.where(held.any(axis=0), (share[1] - share[0]) / error, 0)


def train(rows: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Model:
    """``rows``: for each text its words' rows in the tables. Deterministic."""
    model, rng = Model.start(seed), np.random.default_rng(seed)
    model.embed[:, 0] = EVIDENCE * evidence(rows, labels)
    # The first filters, of width one, begin by reading that coordinate.
    for weights in (model.filters[0], model.out):
        weights[:FILTERS] = np.abs(weights[:FILTERS])
    model.training = True
    tune = {k: Adam(np.shape(getattr(model, k)), RATE) for k in ("embed", "filters", "inner", "out")}
    tune_bias = Adam((1,), RATE)
    share = max(labels.mean(), 1e-3)
    weight = np.where(labels > 0, 0.5 / share, 0.5 / max(1 - share, 1e-3))
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for first in range(0, len(order), BATCH):
            picked = [i for i in order[first : first + BATCH] if len(rows[i])]
            if not picked:
                continue
            ids = np.concatenate([rows[i] for i in picked])
            lengths = np.array([len(rows[i]) for i in picked], dtype=np.int64)
            vectors = model.embed[ids].sum(axis=1)
            best, where = model.pooled(vectors @ model.filters, lengths)
            p = 1 / (1 + np.exp(-(best @ model.out + model.bias)))
            error = ((p - labels[picked]) * weight[picked] / len(picked)).astype(np.float32)
            back = error[:, None] * model.out * (where >= 0)
            d_filters = np.zeros_like(model.filters)
            touched, d_vectors = [], []
            at = 0
            for i, width in enumerate(WIDTHS):
                for k in range(width):
                    for f in range(FILTERS):
                        column, j = (at + k) * FILTERS + f, i * FILTERS + f
                        hit = where[:, j] >= 0
                        places = where[hit, j] + k
                        d_filters[:, column] = vectors[places].T @ back[hit, j]
                        touched.append(places)
                        d_vectors.append(back[hit, j][:, None] * model.filters[:, column])
                at += width
            places, d = np.concatenate(touched), np.concatenate(d_vectors)
            used, inverse = np.unique(ids[places].ravel(), return_inverse=True)
            d_embed = np.zeros((len(used), DIM), np.float32)
            np.add.at(d_embed, inverse, np.repeat(d, HASHES, axis=0))
            model.embed[used] += tune["embed"].step(d_embed, used)
            model.filters += tune["filters"].step(d_filters)
            model.inner += tune["inner"].step(back.sum(axis=0))
            model.out += tune["out"].step(best.T @ error)
            model.bias += float(tune_bias.step(error.sum(keepdims=True))[0])
    model.training = False
    return model


def threshold(counts: np.ndarray, totals: np.ndarray) -> float:
    """The cut with the best F1; the middle of the tied cuts. 0.5 without both classes.

    ``counts``: rows by label (0 or 1) and number of ``CUTS`` that their score reaches;
    ``totals``: the rows of each label that they stand for.
    """
    seen = counts.sum(axis=1)
    if not seen.all():
        return 0.5
    chosen = counts[:, ::-1].cumsum(axis=1)[:, ::-1][:, 1:] * (totals / seen)[:, None]
    f1 = 2 * chosen[1] / (chosen.sum(axis=0) + totals[1])
    return float(np.median(CUTS[f1 >= f1.max() - 1e-9]))


def thresholds(
    picked: DataFrame, known: DataFrame, trained: list[int], model: Model
) -> dict[str | None, float]:
    """Cuts by language and, for None, of all: from the rows of ``picked`` (id, lang, text) that
    ``known`` (id, label) labels, those of the ids ``trained`` for their number only.

    Scores meet the labels, not the texts; the driver gets counts.
    """
    shared = picked.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))

    def scored(batches):
        held = pickle.loads(shared.value)
        for batch in sliced(batches):
            found = pa.array(held.scores_of(batch.column(2).to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], found], names=["id", "lang", "score"])

    rows = picked.select("id", "lang", "text").filter("id IS NOT NULL")
    return _cuts(rows.mapInArrow(scored, "id bigint, lang string, score double"), known, trained)


def _cuts(scored: DataFrame, known: DataFrame, trained: list[int]) -> dict[str | None, float]:
    """Cuts from scores (id, lang, score) and labels, as ``thresholds``."""
    left_out = scored.sparkSession.createDataFrame([(i, True) for i in trained], "id long, trained boolean")
    steps = F.array(*(F.lit(float(c)) for c in CUTS))
    reached = F.size(F.filter(steps, lambda c: c <= F.col("score")))
    counts = materialize(
        scored.filter("id IS NOT NULL")
        .join(known, "id")
        .join(F.broadcast(left_out), "id", "left")
        .groupBy(
            "lang",
            (F.col("label") > 0).cast("int").alias("label"),
            F.when(F.col("trained"), -1).otherwise(reached).alias("reached"),
        )
        .agg(F.count(F.lit(1)).alias("n")),
        "toxicity-counts",
    )
    fresh = lambda label: F.sum(F.when((F.col("label") == label) & (F.col("reached") >= 0), F.col("n")))
    enough = counts.filter("lang IS NOT NULL").groupBy("lang").agg(fresh(0).alias("n0"), fresh(1).alias("n1"))
    enough = enough.filter((F.col("n0") >= LEAST) & (F.col("n1") >= LEAST)).select("lang")
    every = counts.groupBy("label", "reached").agg(F.sum("n").alias("n"))
    rows = every.select(F.lit(None).cast("string").alias("lang"), "label", "reached", "n").collect()
    rows += counts.join(enough, "lang", "left_semi").collect()
    by_lang: dict[str | None, np.ndarray] = {None: np.zeros((2, len(CUTS) + 2))}
    for lang, label, reached, n in rows:
        # The last column has the rows trained on.
        by_lang.setdefault(lang, np.zeros((2, len(CUTS) + 2)))[label, reached] += n
    return {k: threshold(x[:, :-1], x.sum(axis=1)) for k, x in by_lang.items()}


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    lang: str = "lang",
    sample: int = SAMPLE,
    label_id: str = "doc_id",
) -> Model:
    """A model from at most ``sample`` labelled rows of either class, with its thresholds.

    Thresholds come from all labelled rows that were not trained on.
    """
    model, picked, known, trained = _learn(docs, labels, id_col, text, label, lang, sample, label_id)
    if trained:
        model.thresholds = thresholds(picked, known, trained, model)
    return model


def _learn(
    docs: DataFrame, labels: DataFrame, id_col: str, text: str, label: str, lang: str, sample: int, label_id: str
) -> tuple[Model, DataFrame, DataFrame, list[int]]:
    """The model, the documents (id, lang, text), the labels, and the ids trained on.

    The chosen ids (at most twice ``sample``) are broadcast, so the documents are scanned, not
    shuffled; the driver gets word numbers of the chosen rows only.
    """
    known = materialize(
        labels.filter(F.col(label_id).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(label_id).cast("bigint").alias("id"))
        .agg(F.max(label).cast("int").alias("label")),
        "toxicity-labels",
    )
    chosen = None
    for value in (0, 1):
        part = known.filter((F.col("label") > 0) == F.lit(bool(value)))
        part = part.orderBy(F.xxhash64("id"), "id").limit(sample)
        chosen = part if chosen is None else chosen.union(part)

    def numbered(batches):
        for batch in sliced(batches):
            rows = [rows_of(words_of(x)) for x in batch.column(3).to_pylist()]
            packed = pa.array([x.astype("<i4").tobytes() for x in rows], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], packed], names=["id", "label", "lang", "words"]
            )

    picked = docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        (F.col(lang) if lang in docs.columns else F.lit(None)).cast("string").alias("lang"),
        F.col(text).alias("text"),
    )
    rows = (
        picked.join(F.broadcast(chosen), "id")
        .select("id", "label", "lang", "text")
        .mapInArrow(numbered, "id bigint, label int, lang string, words binary")
        .collect()
    )
    rows.sort(key=lambda r: (xxhash.xxh64_intdigest(str(r["id"])), r["words"]))
    if not rows:
        model = Model.start()
        model.out[:] = 0
        model.thresholds = {None: 1.1}
        return model, picked, known, []
    words = [np.frombuffer(r["words"], "<i4").reshape(-1, HASHES) for r in rows]
    y = np.array([r["label"] > 0 for r in rows], dtype=np.float32)
    held = set(list(dict.fromkeys(r["id"] for r in rows))[::CALIBRATION])
    keep = [i for i, r in enumerate(rows) if r["id"] not in held] or list(range(len(rows)))
    model = train([words[i] for i in keep], y[keep])
    return model, picked, known, sorted({rows[i]["id"] for i in keep})


def fit_and_score(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    lang: str = "lang",
    sample: int = SAMPLE,
    label_id: str = "doc_id",
    keep: list[str] | None = None,
) -> DataFrame:
    """``score`` by a model that ``fit`` learns, but every text is scored once.

    The scores are stored with the columns ``keep`` (all, if None); the thresholds come from what
    is stored, so the texts are not read again for them.
    """
    model, _, known, trained = _learn(docs, labels, id_col, text, label, lang, sample, label_id)
    names = [n for n in (docs.columns if keep is None else keep) if n not in OUTPUTS]
    of = lambda name, kind: (F.col(name) if name in docs.columns else F.lit(None)).cast(kind)
    plain = docs.select(
        *(F.col(n).alias(f"c{i}") for i, n in enumerate(names)),
        of(id_col, "bigint").alias("own_id"),
        of(lang, "string").alias("own_lang"),
        F.col(text).alias("own_text"),
    )
    stored = materialize(_scored(plain, model, "own_text").drop("own_text"), "toxicity-scores")
    if trained:
        scores = stored.select(F.col("own_id").alias("id"), F.col("own_lang").alias("lang"), "score")
        model.thresholds = _cuts(scores, known, trained)
    out = _judged(stored, model, F.col("own_lang"))
    return out.drop("own_id", "own_lang").toDF(*names, *OUTPUTS)


def _scored(plain: DataFrame, model: Model, text: str) -> DataFrame:
    """``plain``, whose columns have names of their own, with its score."""
    shared = plain.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))
    names = plain.columns
    at = names.index(text)

    def scored(batches):
        held = pickle.loads(shared.value)
        for batch in sliced(batches):
            found = held.scores_of(batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.float64())], names=[*names, "score"]
            )

    schema = T.StructType([*plain.schema.fields, T.StructField("score", T.DoubleType())])
    return plain.mapInArrow(scored, schema)


def _judged(scored: DataFrame, model: Model, own: Column | None) -> DataFrame:
    """With threshold and rejected, by the language ``own``."""
    cut = F.lit(model.thresholds[None])
    if own is not None:
        for name, value in model.thresholds.items():
            if name is not None:
                cut = F.when(own == name, F.lit(value)).otherwise(cut)
    return scored.withColumn("threshold", cut).withColumn(
        "rejected", F.col("score") >= F.col("threshold")
    )


def score(docs: DataFrame, model: Model, text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` with score, threshold (of the row's language) and rejected."""
    docs = docs.drop(*OUTPUTS)
    names = docs.columns
    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))
    own = F.col(f"c{names.index(lang)}") if lang in names else None
    out = _judged(_scored(plain, model, f"c{names.index(text)}"), model, own)
    return out.toDF(*names, *OUTPUTS)
