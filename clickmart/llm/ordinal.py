"""Quality classifier: ordinal cumulative-link regression of graded ratings on hashed text.

P(grade <= k) = logistic(threshold_k - w . x) with one weight vector for all grades and ordered thresholds. x marks which
hashed words, word beginnings and shape buckets a text has. Fitted on a bounded sample of the rated rows, applied to all.
"""

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash

from pyspark.sql import functions as F

from clickmart.llm.exchange import packed, row_groups, to_batch, unpacked
from clickmart.llm.words import utf8

SLOT_BITS = 18
MAX_ROWS = 12_000
ROUNDS = 120
PENALTY = 3e-4
_WORDS = 200_000
_EDGES = b".,;:!?\"'()[]-"
_SYMBOLS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and c not in _EDGES)
_UPPER = bytes(range(65, 91))
_CHUNK = 3 << 20


class Model(NamedTuple):
    weights: np.ndarray  # one per slot
    thresholds: np.ndarray  # ascending, one fewer than grades


def _slot(feature):
    return xxhash.xxh3_64_intdigest(feature) & ((1 << SLOT_BITS) - 1)


class _Slots(dict):
    """Number of each word; ``table`` has its slots: the word without punctuation, its first four and five bytes."""

    def __init__(self):
        self.table = np.zeros((1024, 3), np.int32)

    def __missing__(self, word):
        bare = word.strip(_EDGES)
        number = len(self)
        if number == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[number] = _slot(bare), _slot(b"4" + bare[:4]), _slot(b"5" + bare[:5])
        self[word] = number
        return number


_SHAPES = (b"symbols", b"capitals", b"repeats", b"distinct", b"shouts", b"bars")
_BUCKETS = 10


def _shape(data, words, distinct):
    """Buckets of shares that tell prose from lists, shouting, repetition and symbol noise."""
    count = max(1, len(words))
    letters = max(1, len(data) - data.count(b" "))
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    shares = (
        (len(data) - len(data.translate(None, _SYMBOLS))) / count,
        (len(data) - len(data.translate(None, _UPPER))) / letters,
        repeats / count,
        distinct / count if count > 50 else 1.0,
        data.count(b"!!") / count,
        data.count(b" | ") / count,
    )
    return [_slot(b"shape %s %d" % (n, min(_BUCKETS, int(_BUCKETS * s)))) for n, s in zip(_SHAPES, shares, strict=True)]


def shape_slots():
    return np.unique([_slot(b"shape %s %d" % (name, n)) for name in _SHAPES for n in range(_BUCKETS + 1)])


def features(rows, slots):
    """The sorted distinct slots of each text (bytes or None, A-Z taken in lower case). Null and empty texts have none."""
    for data in rows:
        words = data.split() if data else []
        if not words:
            yield np.empty(0, np.int64)
            continue
        if len(slots) > _WORDS:
            slots.clear()
        lower = set(data.lower().split())
        at = np.fromiter(map(slots.__getitem__, lower), np.int64, len(lower))
        yield np.unique(np.concatenate([slots.table[at].ravel(), _shape(data, words, len(lower))]))


def grades(labels):
    """Ratings as grades: 0 toxic, 1 neither toxic nor good, 2 good. Rows without both ratings are left out."""
    rated = labels.where("doc_id is not null and quality is not null and toxic is not null")
    return rated.select("doc_id", F.when(F.col("toxic") > 0, 0).when(F.col("quality") > 0, 2).otherwise(1).alias("grade"))


def training_sample(docs, rated, max_rows=MAX_ROWS):
    """``grade, slots`` of about ``max_rows`` rated documents, never more, chosen by a hash of the id.

    ``max_rows`` bounds what reaches the driver; it is the only sample in this module. A document with several ratings
    counts with each.
    """
    total = rated.count()
    share = min(1.0, 1.2 * max_rows / max(1, total))
    mark = F.xxhash64("doc_id", F.lit("sample"))
    chosen = rated.where(mark < F.lit(int((share - 0.5) * 2.0**64) if share < 1 else 2**63 - 1)).orderBy(mark, "grade").limit(max_rows)
    # at most ``max_rows`` rows of two numbers
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def code(batches):
        slots = _Slots()
        schema = pa.schema([("doc_id", pa.int64()), ("grade", pa.int32()), ("slots", pa.binary())])
        for table in row_groups(batches, "text", _CHUNK):
            found = [packed(x.astype(np.int32)) for x in features(utf8(table.column("text")), slots)]
            yield to_batch(
                [*zip(table.column("doc_id").to_pylist(), table.column("grade").to_pylist(), found, strict=True)], schema
            )

    coded = rows.select("doc_id", "grade", "text").mapInArrow(code, "doc_id long, grade int, slots binary")
    return coded.orderBy("doc_id", "grade", F.xxhash64("slots")).limit(max_rows).select("grade", "slots")


def _logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(rows, levels=3, rounds=ROUNDS, penalty=PENALTY, least_rows=4):
    """A model from (grade, sorted slots) rows: penalised likelihood by adaptive gradient steps from zero.

    Words can only lower a grade, so that a long text gains nothing by its length, and a penalty on the sum of their
    weights leaves most at 0; shapes may do both. Slots in fewer than ``least_rows`` rows keep weight 0. Without rows
    every text has the highest grade.
    """
    size = 1 << SLOT_BITS
    if not rows:
        return Model(np.zeros(size, np.float32), np.full(levels - 1, -40.0))
    grade = np.array([g for g, _ in rows])
    lengths = np.array([len(s) for _, s in rows])
    slots = np.concatenate([s for _, s in rows]).astype(np.int64)
    support = np.bincount(slots, minlength=size)
    keep = support[slots] >= least_rows
    row = np.repeat(np.arange(len(rows)), lengths)[keep].astype(np.int32)
    slots = slots[keep].astype(np.int32)
    used, slots = np.unique(slots, return_inverse=True)
    slots = slots.astype(np.int32)
    bound = ~np.isin(used, shape_slots())
    # parameters: weights, the lowest threshold, logs of the gaps above it
    shares = np.clip(np.cumsum(np.bincount(grade, minlength=levels))[:-1] / len(grade), 1e-3, 1 - 1e-3)
    start = np.log(shares / (1 - shares))
    gaps = np.log(np.maximum(np.diff(start), 0.5))
    values = np.concatenate([np.zeros(len(used)), start[:1], gaps])
    mean, square = np.zeros_like(values), np.zeros_like(values)
    width, count = len(used), len(rows)
    for step in range(1, rounds + 1):
        thresholds = values[width] + np.concatenate(([0], np.cumsum(np.exp(values[width + 1 :]))))
        score = np.bincount(row, values[slots], count)
        padded = np.concatenate(([-np.inf], thresholds, [np.inf]))
        high, low = _logistic(padded[grade + 1] - score), _logistic(padded[grade] - score)
        high, low = np.where(grade == levels - 1, 1.0, high), np.where(grade == 0, 0.0, low)
        mass = np.maximum(high - low, 1e-12)
        to_score = high + low - 1
        to_high, to_low = high * (1 - high) / mass, -low * (1 - low) / mass
        each = np.zeros(levels - 1)
        np.add.at(each, grade[grade < levels - 1], to_high[grade < levels - 1])
        np.add.at(each, grade[grade > 0] - 1, to_low[grade > 0])
        gap = np.exp(values[width + 1 :]) * np.cumsum(each[::-1])[::-1][1:]
        slope = np.concatenate([np.bincount(slots, to_score[row], width), [each.sum()], gap]) / count
        slope[:width][bound] += penalty
        mean = 0.9 * mean + 0.1 * slope
        square = 0.999 * square + 0.001 * slope**2
        values += 0.1 * mean / (1 - 0.9**step) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
        values[:width][bound] = np.minimum(values[:width][bound], 0)
    weights = np.zeros(size, np.float32)
    weights[used] = values[:width]
    return Model(weights, values[width] + np.concatenate(([0], np.cumsum(np.exp(values[width + 1 :])))))


def fit_sample(docs, labels, max_rows=MAX_ROWS):
    rows = training_sample(docs, grades(labels), max_rows).collect()
    return fit([(row["grade"], unpacked(bytes(row["slots"]), np.int32)) for row in rows])


def rate(docs, model, text="text", least=0.5):
    """``docs`` with ``expected_grade``, ``tail_probability`` (of the highest grade) and ``selected``.

    A text is selected when its tail probability is at least ``least``. Null and empty texts have no features and get
    the ratings of the thresholds alone. Repeated rows are rated alike; columns named like those added are replaced.
    The model is 2^18 weights, whatever the data.
    """
    added = {"expected_grade": "double", "tail_probability": "double", "selected": "boolean"}
    docs = docs.drop(*added)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds))

    def rated(batches):
        weights, thresholds = shared.value
        slots = _Slots()
        for table in row_groups(batches, text, _CHUNK):
            scores = np.array([weights[found].sum(dtype=np.float64) for found in features(utf8(table.column(text)), slots)])
            above = 1 - _logistic(thresholds[None, :] - scores[:, None])
            for name, values in (
                ("expected_grade", pa.array(above.sum(axis=1))),
                ("tail_probability", pa.array(above[:, -1])),
                ("selected", pa.array(above[:, -1] >= least)),
            ):
                table = table.append_column(name, values)
            yield from table.to_batches()

    schema = docs.limit(0).selectExpr("*", *[f"cast(null as {kind}) as {name}" for name, kind in added.items()]).schema
    return docs.mapInArrow(rated, schema)
