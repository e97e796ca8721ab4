"""Quality rules: base counts, and hashed n-gram logistic regressions behind fixed thresholds.

Two models are trained on labelled rows. The quality model sees how often hashed words, character
4-grams and their shapes occur, as shares of the text, so length has no say. The toxicity model sees
which hashed words and character 7-grams at the beginnings of words occur at all, so that one word counts
the same in a short and in a long text. (Pairs of words, tried in both, let 5.2 % of toxic held-out rows
through in place of 1.5 %.)
Features are made in Spark tasks, of whole texts. The driver takes those of the bounded sample, as Arrow
and in parts, and trains on them in stretches.
Both are calibrated on held-out labelled rows (Platt scaling), and every document is scored in Arrow
batches against fixed probabilities.

Defined cases: a null or empty text has no words, fails the base rule and is not kept. Labels that
are null, and labels whose document is missing, are left out of training; a document labelled twice
is trained on twice. Without a label of both kinds the model abstains, and the base rule alone
decides. Repeated rows give repeated results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StructField,
    StructType,
)

from cardledger.llm.texts import GROUP_BYTES, Prefix, Words, as_bytes, groups, mix
from cardledger.sources.scratch import saved

MAX_LABELLED = 8_000  # rows that training takes at most, chosen by a hash of their id
MAX_QUALITY = 3_000  # the first of these rows, which train the quality model
MIN_GOOD = 0.5  # calibrated probability of good quality that a kept document has at least
MAX_TOXIC = 0.2  # calibrated probability of toxicity from which a document is rejected
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
BITS = 17  # hashed features per kind
GRAM = 4
KINDS = 3  # of features in the quality model: character 4-grams, their shapes, words
BEGINNINGS = (7,)  # bytes of a word's beginning that are a feature of their own
PART_ROWS = 500  # rows whose features the driver takes at a time
STRETCH = 1 << 20  # features worked on at a time in training

_space = np.zeros(256, bool)
_space[[0x20, *range(0x09, 0x0E)]] = True
_symbol = np.zeros(256, bool)
_symbol[list(b"#*$%&|<>")] = True
_starts = np.ones(256, bool)  # bytes that start a code point
_starts[0x80:0xC0] = False
_shape = np.zeros(256, np.uint8)  # kinds of characters: lower, upper, digit, other, space, and symbols as they are
for _b in range(256):
    _c = chr(_b)
    _shape[_b] = 0 if _space[_b] else 1 if _c.islower() or _b >= 0x80 else 2 if _c.isupper() else 3 if _c.isdigit() else _b
_lower = np.arange(256, dtype=np.uint8)
_lower[0x41:0x5B] += 32


def _per_text(at: np.ndarray, positions: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(np.searchsorted(at, positions, "right") - 1, minlength=n)[:n]


@dataclass
class Measured:
    """A group of texts: word edges, and the counts of the base rules."""

    data: np.ndarray
    at: np.ndarray
    start: np.ndarray
    end: np.ndarray
    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray


def measure(texts: list[bytes]) -> Measured:
    """Base counts of each text. Lines and windows are compared by 64-bit hashes inside a text."""
    n = len(texts)
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    at = np.cumsum([0] + [len(t) + 1 for t in texts])
    inside = np.zeros(len(data) + 1, np.int8)
    inside[1:] = ~_space[data]
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    owner = np.searchsorted(at, start, "right") - 1
    n_words = np.bincount(owner, minlength=n)[:n]
    counted = _starts[data] & ~_space[data]
    word_chars = np.add.reduceat(counted.astype(np.int64), at[:-1]) if n else np.zeros(0, np.int64)
    hashes = Prefix(data)

    breaks = np.flatnonzero(data == 0x0A)
    line_start = np.r_[0, breaks[:-1] + 1] if len(breaks) else np.zeros(0, np.int64)
    worded = np.searchsorted(start, breaks) > np.searchsorted(start, line_start)
    line_start, line_end = line_start[worded], breaks[worded]
    line_owner = np.searchsorted(at, line_start, "right") - 1
    key = hashes.hashes(line_start, line_end) ^ mix(line_owner.astype(np.uint64) + np.uint64(1))
    again = np.ones(len(key), bool)
    again[np.unique(key, return_index=True)[1]] = False
    n_dup_lines = np.bincount(line_owner[again], minlength=n)[:n]

    n_repeat = np.zeros(n, np.int64)
    if len(start) >= 3:
        words = Prefix(hashes.hashes(start, end))
        k = np.arange(len(start) - 2)
        whole = owner[k] == owner[k + 2]
        k = k[whole]
        key = words.hashes(k, k + 3) ^ mix(owner[k].astype(np.uint64) + np.uint64(1))
        _, back, times = np.unique(key, return_inverse=True, return_counts=True)
        twice = k[times[back] >= 2]
        hit = np.zeros(len(start), bool)
        for j in range(3):
            hit[twice + j] = True
        n_repeat = np.bincount(owner[hit], minlength=n)[:n]
    return Measured(
        data, at, start, end, n_words, word_chars,
        _per_text(at, np.flatnonzero(_symbol[data]), n), n_dup_lines, n_repeat,
    )


def _bucket(h: np.ndarray, kind: int) -> np.ndarray:
    return (mix(h + np.uint64(kind)) >> np.uint64(64 - BITS)).astype(np.int64)


def _words_of(m: Measured) -> tuple[Words, np.ndarray]:
    """The lower-cased words of all texts, and the text of each."""
    words = Words([m.data.tobytes()])
    return words, np.searchsorted(m.at, words.start, "right") - 1


def _marks_of(m: Measured) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of words and of the character n-grams they begin with; owners."""
    words, owner = _words_of(m)
    buckets, owners = [_bucket(words.hash, 1)], [owner]
    for n in BEGINNINGS:
        long = words.end - words.start > n
        start = words.start[long]
        buckets.append(_bucket(words.prefix.hashes(start, start + n), 3 + n))
        owners.append(owner[long])
    return np.concatenate(buckets), np.concatenate(owners)


def _grams_of(m: Measured) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hash buckets, one kind after the other, with owners: character 4-grams of the lower-cased text and
    of its shape, words."""
    k = np.arange(max(len(m.data) - GRAM + 1, 0))
    owner = np.searchsorted(m.at, k, "right") - 1
    inside = k + GRAM < m.at[owner + 1] if len(k) else np.zeros(0, bool)
    k, owner = k[inside], owner[inside]
    for kind, table in ((2, _lower), (3, _shape)):
        # GRAM bytes fit into one 32-bit value: no prefix hash is needed.
        coded = table[m.data].astype(np.uint64)
        value = np.zeros(len(k), np.uint64)
        for j in range(GRAM):
            value = (value << np.uint64(8)) | coded[k + j]
        yield (kind - 2) * (1 << BITS) + _bucket(value, kind), owner
    words, owner = _words_of(m)
    yield 2 * (1 << BITS) + _bucket(words.hash, 4), owner


@dataclass
class Model:
    """Weights per bucket, and the calibration: probability = sigmoid(scale * score + shift)."""

    weights: np.ndarray
    bias: float
    scale: float = 1.0
    shift: float = 0.0

    def probability(self, scores: np.ndarray) -> np.ndarray:
        return _sigmoid(self.scale * scores + self.shift)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


Sparse = tuple[np.ndarray, np.ndarray, np.ndarray]  # row, bucket, value


def quality_features(m: Measured) -> Sparse:
    """Square roots of the shares of features: a text's features have length 1 per kind."""
    n, rows, cols, values = len(m.n_words), [], [], []
    for bucket, owner in _grams_of(m):
        key, times = np.unique(owner * (KINDS << BITS) + bucket, return_counts=True)
        row = key // (KINDS << BITS)
        total = np.bincount(row, times, minlength=n)
        rows.append(row)
        cols.append(key % (KINDS << BITS))
        values.append(np.sqrt(times / total[row]))
    return np.concatenate(rows), np.concatenate(cols), np.concatenate(values)


def toxic_features(m: Measured) -> Sparse:
    """1 for every hashed word or beginning of a word that occurs."""
    bucket, owner = _marks_of(m)
    key = np.unique(owner * (1 << BITS) + bucket)
    return key >> BITS, key & ((1 << BITS) - 1), np.ones(len(key))


def scores(model: Model, features: Sparse, n: int) -> np.ndarray:
    row, col, value = features
    return np.bincount(row, model.weights[col] * value, minlength=n)[:n] + model.bias


def toxic_scores(model: Model, m: Measured) -> np.ndarray:
    """`scores` of `toxic_features`, without sorting the many words of weight 0."""
    bucket, owner = _marks_of(m)
    weighs = model.weights[bucket] != 0
    key = np.unique(owner[weighs] * (1 << BITS) + bucket[weighs])
    n = len(m.n_words)
    return np.bincount(key >> BITS, model.weights[key & ((1 << BITS) - 1)], minlength=n)[:n] + model.bias


class Rows:
    """Features of rows, one after the other: `col` and `value` (None: all 1) from first[i] to first[i + 1]."""

    def __init__(self, cols: list[np.ndarray], values: list[np.ndarray] | None):
        self.first = np.cumsum([0] + [len(c) for c in cols])
        self.col = np.concatenate([np.zeros(0, np.int32), *cols])
        self.value = None if values is None else np.concatenate([np.zeros(0, np.float32), *values])

    def stretches(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray | float]]:
        """Rows a to b, some STRETCH of features at a time: (a, b, each feature's row from a on, buckets, values)."""
        cut = np.flatnonzero(np.diff(self.first[1:] // STRETCH)) + 1
        n = len(self.first) - 1
        for a, b in zip(np.r_[0, cut], np.r_[cut, n]):
            begin, end = self.first[a], self.first[b]
            value = 1.0 if self.value is None else self.value[begin:end]
            yield a, b, np.repeat(np.arange(b - a), np.diff(self.first[a : b + 1])), self.col[begin:end], value

    def scores(self, weights: np.ndarray, bias: float) -> np.ndarray:
        out = np.full(len(self.first) - 1, bias)
        for a, b, row, col, value in self.stretches():
            out[a:b] += np.bincount(row, weights[col] * value, minlength=b - a)
        return out

    def gradient(self, error: np.ndarray, width: int) -> np.ndarray:
        out = np.zeros(width)
        for a, b, row, col, value in self.stretches():
            out += np.bincount(col, error[a:b][row] * value, minlength=width)
        return out


def fit(features: Rows, fitting: np.ndarray, y: np.ndarray, width: int, l1: float, rate: float, rounds: int = 120) -> Model:
    """Logistic regression on the rows marked `fitting` by proximal gradient steps (Adam's scaling),
    classes weighted evenly."""
    share, n = y[fitting].mean(), fitting.sum()
    weight = np.where(y == 1, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9)) / n * fitting
    w, bias = np.zeros(width), 0.0
    square, square_b, step, step_b = np.zeros(width), 0.0, np.zeros(width), 0.0
    for t in range(1, rounds + 1):
        error = (_sigmoid(features.scores(w, bias)) - y) * weight
        g, g_b = features.gradient(error, width), error.sum()
        step, step_b = 0.9 * step + 0.1 * g, 0.9 * step_b + 0.1 * g_b
        square, square_b = 0.99 * square + 0.01 * g * g, 0.99 * square_b + 0.01 * g_b * g_b
        c1, c2 = 1 - 0.9**t, 1 - 0.99**t
        pace = rate / (np.sqrt(square / c2) + 1e-6)
        w = w - pace * step / c1
        w = np.sign(w) * np.maximum(np.abs(w) - pace * l1, 0)
        bias -= rate * (step_b / c1) / (np.sqrt(square_b / c2) + 1e-6)
    return Model(w, float(bias))


def calibrate(model: Model, held_scores: np.ndarray, y: np.ndarray) -> Model:
    """Platt scaling by Newton steps on rows that training has not seen, in their own proportions."""
    if not 0 < y.mean() < 1:
        return model
    target = np.where(y == 1, 1 - 1 / (2 + y.sum()), 1 / (2 + (1 - y).sum()))
    spread = held_scores.std() or 1.0
    x = np.c_[held_scores / spread, np.ones(len(y))]
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = _sigmoid(x @ theta)
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        theta = theta - np.clip(np.linalg.solve(h, x.T @ (p - target) + 1e-3 * (theta - [1, 0])), -2, 2)
    return Model(model.weights, model.bias, float(theta[0] / spread), float(theta[1]))


def fitted(features: Rows, y: np.ndarray, width: int, penalties: tuple[float, ...], rate: float) -> Model | None:
    """A model of the marks y (0, 1; -1: none). Every fifth row calibrates, and chooses the penalty."""
    held, known = np.arange(len(y)) % 5 == 4, y >= 0
    fitting, checking = ~held & known, held & known
    if len(set(y[fitting])) < 2 or len(set(y[checking])) < 2:
        return None
    tried = []
    for l1 in penalties:  # the one that says most about the rows held out
        model = fit(features, fitting, y, width, l1, rate)
        held_scores = features.scores(model.weights, model.bias)[checking]
        model = calibrate(model, held_scores, y[checking])
        p = np.clip(model.probability(held_scores), 1e-6, 1 - 1e-6)
        tried.append((-np.log(np.where(y[checking] == 1, p, 1 - p)).mean(), model))
    return min(tried, key=lambda t: t[0])[1]


def quality_model(features: Rows, good: np.ndarray) -> Model | None:
    return fitted(features, good, KINDS << BITS, (2e-6,), 0.05)


def toxicity_model(features: Rows, toxic: np.ndarray) -> Model | None:
    return fitted(features, toxic, 1 << BITS, (5e-4, 5e-3, 2e-2), 0.05)


def _by_text(features: Sparse, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, values) per text."""
    row, col, value = features
    order = np.argsort(row, kind="stable")
    bounds = np.searchsorted(row[order], np.arange(n + 1))
    col, value = col[order].astype(np.int32), value[order].astype(np.float32)
    for a, b in zip(bounds, bounds[1:]):
        yield col[a:b], value[a:b]


def train(texts: list[bytes], good: np.ndarray, toxic: np.ndarray) -> tuple[Model | None, Model | None]:
    """The two models from labelled texts that are at hand; `learn` is the way for tables."""
    quality, toxicity = [], []
    for first, group in groups(texts):
        m = measure(group)
        if first < MAX_QUALITY:
            quality += _by_text(quality_features(m), len(group))
        toxicity += _by_text(toxic_features(m), len(group))
    quality = quality[:MAX_QUALITY]
    return (
        quality_model(Rows([c for c, _ in quality], [v for _, v in quality]), good[: len(quality)]),
        toxicity_model(Rows([c for c, _ in toxicity], None), toxic),
    )


def chosen(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """`most` labelled rows at most, in an order set by hashes: place, _id, _text (a hash), quality, toxic."""
    wanted = labels.select(F.col("doc_id").alias("_id"), "quality", "toxic").where("_id is not null")
    total = wanted.count()
    if total > most:  # about `most` before the join
        wanted = wanted.where(F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) < int(1_000_000 * 1.2 * most / total))
    slim = docs.select("doc_id", F.xxhash64("text").alias("_text"))
    rows = slim.join(wanted, F.col("doc_id") == F.col("_id")).select("_id", "_text", "quality", "toxic")
    order = [F.xxhash64("_id"), "_id", "_text", "quality", "toxic"]
    rows = rows.orderBy(*order).limit(most)  # slim rows
    return saved(rows.withColumn("place", F.row_number().over(Window.orderBy(*order)) - 1), "chosen")


def _texts_of(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The texts of chosen rows, once each: _id, _text, text, _first (their first place)."""
    texts = docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_text"), "text")
    first = rows.groupBy("_id", "_text").agg(F.min("place").alias("_first"))
    return texts.join(first, ["_id", "_text"]).dropDuplicates(["_id", "_text"])


def labelled_rows(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """At most `most` labelled texts on the driver, chosen by a hash of their id."""
    wanted = chosen(docs, labels, most)
    rows = wanted.join(_texts_of(docs, wanted), ["_id", "_text"]).orderBy("place").collect()  # `most` at most
    texts = [(r.text or "").encode() for r in rows]
    mark = [np.array([-1 if r[c] is None else int(r[c]) for r in rows], int) for c in ("quality", "toxic")]
    return texts, mark[0], mark[1]


FEATURES = StructType(
    [
        StructField("_id", LongType()),
        StructField("_text", LongType()),
        StructField("quality_col", ArrayType(IntegerType())),
        StructField("quality_value", ArrayType(FloatType())),
        StructField("toxic_col", ArrayType(IntegerType())),
    ]
)


def features_of(texts: DataFrame) -> DataFrame:
    """FEATURES of texts (_id, _text, text, _first); for quality of those that its model trains on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch["_first"].to_pylist()
            for first, group in groups(as_bytes(batch["text"]), GROUP_BYTES // 4):
                m = measure(group)
                quality = list(_by_text(quality_features(m), len(group)))
                for i, place in enumerate(places[first : first + len(group)]):
                    if place >= MAX_QUALITY:
                        quality[i] = (quality[i][0][:0], quality[i][1][:0])
                toxic = list(_by_text(toxic_features(m), len(group)))
                lists = [[c for c, _ in quality], [v for _, v in quality], [c for c, _ in toxic]]
                columns = [batch[c].slice(first, len(group)).cast(pa.int64()) for c in ("_id", "_text")]
                for values, kind in zip(lists, (pa.int32(), pa.float32(), pa.int32())):
                    bounds = pa.array(np.cumsum([0] + [len(v) for v in values]), pa.int32())
                    columns.append(pa.ListArray.from_arrays(bounds, pa.array(np.concatenate(values), kind)))
                yield pa.RecordBatch.from_arrays(columns, names=FEATURES.names)

    return texts.mapInArrow(run, FEATURES)


def _lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    flat = column.combine_chunks()
    bounds = flat.offsets.to_numpy()
    values = flat.values.to_numpy()
    return [values[a:b] for a, b in zip(bounds, bounds[1:])]


def learn(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> tuple[Model | None, Model | None]:
    """The two models from at most `most` labelled rows (the first MAX_QUALITY of them for quality)."""
    wanted = chosen(docs, labels, most)
    made = saved(wanted.join(features_of(_texts_of(docs, wanted)), ["_id", "_text"]), "features")

    def rows_of(last: int, col: str, value: str | None, mark: str) -> tuple[Rows, np.ndarray]:
        cols, values, marks = [], [], []
        for place in range(0, last, PART_ROWS):
            part = made.where((F.col("place") >= place) & (F.col("place") < min(last, place + PART_ROWS)))
            table = part.select("place", mark, col, *([value] if value else [])).toArrow().sort_by("place")
            cols += _lists(table[col])
            values += _lists(table[value]) if value else []
            marks += [-1 if m is None else int(m) for m in table[mark].to_pylist()]
        return Rows(cols, values if value else None), np.array(marks, int)

    n = made.count()
    quality = quality_model(*rows_of(min(n, MAX_QUALITY), "quality_col", "quality_value", "quality"))
    return quality, toxicity_model(*rows_of(n, "toxic_col", None, "toxic"))


SCORED = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("n_words", LongType()),
        StructField("word_chars", LongType()),
        StructField("n_symbols", LongType()),
        StructField("n_dup_lines", LongType()),
        StructField("n_repeat_words", LongType()),
        StructField("base_failed", BooleanType()),
        StructField("good", DoubleType()),
        StructField("toxic", DoubleType()),
        StructField("kept", BooleanType()),
    ]
)


def judge(texts: list[bytes], models: tuple[Model | None, Model | None]) -> dict[str, np.ndarray]:
    """All columns of SCORED but the id, for one batch of whole texts."""
    parts = []
    quality, toxicity = models
    for _, group in groups(texts, GROUP_BYTES // 4):
        m = measure(group)
        n = len(group)
        part = {k: getattr(m, k) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
        part["base_failed"] = (m.n_words < MIN_WORDS) | (
            100 * m.n_repeat_words > MAX_REPEATED_PERCENT * m.n_words
        )
        part["good"] = quality.probability(scores(quality, quality_features(m), n)) if quality else np.ones(n)
        part["toxic"] = toxicity.probability(toxic_scores(toxicity, m)) if toxicity else np.zeros(n)
        part["kept"] = ~part["base_failed"] & (part["good"] >= MIN_GOOD) & (part["toxic"] < MAX_TOXIC)
        parts.append(part)
    return {k: np.concatenate([p[k] for p in parts]) for k in parts[0]} if parts else {}


def score(docs: DataFrame, models: tuple[Model | None, Model | None]) -> DataFrame:
    """SCORED for every row of `docs`, which needs doc_id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = judge(as_bytes(batch["text"]), models)
                columns = [batch["doc_id"].cast(pa.int64())] + [pa.array(made[k]) for k in SCORED.names[1:]]
                yield pa.RecordBatch.from_arrays(columns, names=SCORED.names)

    return docs.select("doc_id", "text").mapInArrow(run, SCORED)


def keep(docs: DataFrame, models: tuple[Model | None, Model | None]) -> DataFrame:
    """The rows of `docs`, with all their columns, that are kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(judge(as_bytes(batch["text"]), models)["kept"]))

    return docs.mapInArrow(run, docs.schema)
