"""A convolutional text classifier over hashed word embeddings, trained in numpy.

A word's vector is the sum of two rows of a fixed table, so words that share one row still
differ. Filters over one, two and three words slide over the whole text, the largest answer
of each filter is its feature, and a logistic unit weighs the features. The first component
of a row starts as how much its words lean towards one class in the labelled texts; everything
is then trained together by gradients through the largest answers.

Training uses every labelled text that is not held out, whole; copies of a text teach once. In
each epoch the texts are dealt anew into shards of about ``SHARD``; a task trains a copy of the
model on its shard, and the copies are averaged: a table row over the shards that changed it,
all else over all shards. Sums are those of whole numbers, so their order does not matter. The
driver holds the model, whose size is fixed by the parameters below, and no text. Every text is
scored whole, in Spark, with the broadcast model.

A threshold per language is calibrated on the one in ``CALIBRATES`` labelled texts that do not
train; it is a column of the result and no input of the score. Languages with too few examples
of both classes get the common threshold.

Defined cases: an empty or NULL text is scored by the bias alone; a NULL id is not held out;
without both classes to train on every score is the share of toxic rows (0 without rows);
labels of ids that repeat count once, the highest; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from vitrina.llm.tables import discard, table, with_settings, written

THRESHOLD = 0.7
#: Texts of a shard on average.
SHARD = 2000
#: Rows of the table, components, filters of each width.
BUCKETS, SIZE, FILTERS, WIDTHS = 1 << 17, 12, 12, (1, 2, 3)
EPOCHS, GROUP, RATE = 4, 16, 0.02
#: One of this many labelled texts calibrates; examples of each class that a language needs.
CALIBRATES, FEW = 5, 8
#: Words scored at once.
CHUNK = 1 << 16
CACHED = 1 << 18
#: Changes of parameters are summed as multiples of one over this.
UNIT = 1 << 44

#: Ids of labels as a Bloom filter of 8 MB, so that other texts are dropped before they are shuffled.
LABELLED_FIRST = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1t",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "4000000",
    "spark.sql.optimizer.runtime.bloomFilter.numBits": "67108864",
    # Only the first join gets one, not labels from all documents.
    "spark.sql.optimizer.runtimeFilter.number.threshold": "1",
}

WORD = regex.compile(r"[^\W_]+")
PAD = max(WIDTHS) - 1


class Rows(dict):
    """The two table rows of a word as one number; starts anew when full."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHED:
            self.clear()
        hashed = xxhash.xxh3_64_intdigest(word.encode("utf-8", "replace"))
        first, second = hashed % BUCKETS, (hashed >> 32) % BUCKETS
        value = self[word] = first << 32 | second
        return value


_rows = Rows()


def rows_of(text: str) -> np.ndarray:
    """Table rows of the words of a text, a pair each."""
    return _unpacked(_packed(text))


def _packed(text: str) -> np.ndarray:
    """Both table rows of each word as one number."""
    words = WORD.findall(text.lower())
    return np.fromiter(map(_rows.__getitem__, words), dtype=np.int64, count=len(words))


def _unpacked(pairs: np.ndarray) -> np.ndarray:
    return np.stack([pairs >> 32, pairs & 0xFFFFFFFF], axis=1)


@dataclass
class Model:
    """Parameters; ``constant`` is set when there was nothing to learn from."""

    table: np.ndarray
    filters: list[np.ndarray]  # one [width, SIZE, FILTERS] for each width
    shift: np.ndarray
    weights: np.ndarray
    bias: float
    constant: float | None = None

    def score(self, texts: list[str]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        return self.score_rows(map(rows_of, texts))

    def score_rows(self, texts: Iterable[np.ndarray]) -> np.ndarray:
        """The scores of texts given as table rows."""
        out, held, size = [], [], 0
        for rows in texts:
            held.append(rows)
            size += len(rows)
            if size > CHUNK:
                out.append(self._score(held))
                held, size = [], 0
        if held:
            out.append(self._score(held))
        return np.concatenate(out) if out else np.zeros(0)

    def _score(self, texts: list[np.ndarray]) -> np.ndarray:
        counts = np.array([max(1, len(rows)) for rows in texts])
        starts = np.cumsum(counts + PAD) - counts - PAD
        vectors = np.zeros((int(counts.sum() + PAD * len(texts)), SIZE), dtype=np.float32)
        rows = np.concatenate(texts)
        sizes = np.array([len(one) for one in texts])
        places = np.arange(len(rows)) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
        vectors[places] = self.table[rows[:, 0]] + self.table[rows[:, 1]]
        bounds = np.stack([starts, starts + counts], axis=1).ravel()
        features = []
        for filters in self.filters:
            answers = vectors @ filters[0]
            for step in range(1, len(filters)):
                answers[:-step] += vectors[step:] @ filters[step]
            features.append(np.maximum.reduceat(answers, bounds, axis=0)[::2])
        active = np.maximum(np.concatenate(features, axis=1) + self.shift, 0.0)
        return 1.0 / (1.0 + np.exp(-(active @ self.weights + self.bias).astype(np.float64)))


def _seen(texts: Iterable[np.ndarray], labels: Iterable[float]) -> np.ndarray:
    """Per class and table row the number of texts with the row."""
    seen = np.zeros((2, BUCKETS), dtype=np.int64)
    for rows, label in zip(texts, labels):
        seen[int(label), np.unique(rows)] += 1
    return seen


def _leaning(seen: np.ndarray, clean: int, toxic: int) -> np.ndarray:
    """Per table row the difference of its shares in toxic and clean texts, in deviations."""
    share = (seen.sum(axis=0) + 1) / (clean + toxic + 2)
    gap = seen[1] / toxic - seen[0] / clean
    deviations = gap / np.sqrt(share * (1 - share) * (1 / toxic + 1 / clean))
    return np.clip(deviations, -8, 8) / 8


@dataclass
class Training:
    """A model in training, what its optimizer remembers, and the weight of each class."""

    model: Model
    weight: tuple[float, float]
    first: list[np.ndarray] = field(default_factory=list)
    second: list[np.ndarray] = field(default_factory=list)
    squares: np.ndarray = field(default_factory=lambda: np.full(BUCKETS, 1e-4, dtype=np.float32))
    bias_square: float = 1e-4
    steps: float = 0.0

    @property
    def dense(self) -> list[np.ndarray]:
        return [*self.model.filters, self.model.shift, self.model.weights]

    def learn(self, texts: list[np.ndarray], labels: list[float]) -> None:
        """One step of the optimizer, for up to ``GROUP`` texts."""
        model, dense = self.model, self.dense
        slopes = [np.zeros_like(one) for one in dense]
        bias_slope = 0.0
        touched, pushes = [], []
        for rows, label in zip(texts, labels):
            bias_slope += _slopes(model, rows, label, self.weight[int(label)], slopes, touched, pushes)
        self.steps += 1
        for place, (values, slope) in enumerate(zip(dense, slopes)):
            slope /= GROUP
            self.first[place] += 0.1 * (slope - self.first[place])
            self.second[place] += 0.001 * (slope * slope - self.second[place])
            mean = self.first[place] / (1 - 0.9**self.steps)
            spread = np.sqrt(self.second[place] / (1 - 0.999**self.steps)) + 1e-8
            values -= RATE * mean / spread
        bias_slope /= GROUP
        self.bias_square += bias_slope * bias_slope
        model.bias -= RATE * bias_slope / np.sqrt(self.bias_square)
        if touched:
            where, which = np.unique(np.concatenate(touched), return_inverse=True)
            total = np.zeros((len(where), SIZE), dtype=np.float32)
            np.add.at(total, which, np.concatenate(pushes) / GROUP)
            self.squares[where] += (total * total).sum(axis=1)
            model.table[where] -= RATE * total / np.sqrt(self.squares[where])[:, None]

    def flat(self) -> np.ndarray:
        """All but the table and its squares as one list of numbers."""
        parts = [one.ravel() for one in (*self.dense, *self.first, *self.second)]
        return np.concatenate([*parts, [self.model.bias, self.bias_square, self.steps]]).astype(np.float64)

    def set_flat(self, numbers: np.ndarray) -> None:
        at = 0
        for one in (*self.dense, *self.first, *self.second):
            one[...] = numbers[at : at + one.size].reshape(one.shape)
            at += one.size
        self.model.bias, self.bias_square, self.steps = map(float, numbers[at:])


def _start(random: np.random.Generator, seen: np.ndarray, clean: int, toxic: int) -> Training:
    """The model before its first step; both classes weigh the same."""
    model = Model(
        random.normal(0, 0.05, (BUCKETS, SIZE)).astype(np.float32),
        [random.normal(0, 0.3, (width, SIZE, FILTERS)).astype(np.float32) for width in WIDTHS],
        np.zeros(len(WIDTHS) * FILTERS, dtype=np.float32),
        random.normal(0.2, 0.1, len(WIDTHS) * FILTERS).astype(np.float32),
        -1.0,
    )
    model.table[:, 0] = _leaning(seen, clean, toxic)
    for filters in model.filters:
        filters[:, 0, :] = np.abs(filters[:, 0, :]) * 4
    share = toxic / (clean + toxic)
    training = Training(model, (0.5 / (1 - share), 0.5 / share))
    training.first = [np.zeros_like(one) for one in training.dense]
    training.second = [np.zeros_like(one) for one in training.dense]
    return training


def _constant(share: float) -> Model:
    return Model(np.zeros((1, SIZE)), [], np.zeros(0), np.zeros(0), 0.0, share)


def train(texts: list[str], labels: np.ndarray, seed: int = 7) -> Model:
    """The model learnt from texts with labels 0 and 1 that fit in memory, as one shard."""
    if not len(labels) or labels.min() == labels.max():
        return _constant(float(labels.mean()) if len(labels) else 0.0)
    random = np.random.default_rng(seed)
    rows = [rows_of(text) for text in texts]
    toxic = int(labels.sum())
    training = _start(random, _seen(rows, labels), len(labels) - toxic, toxic)
    for _ in range(EPOCHS):
        order = random.permutation(len(rows))
        for at in range(0, len(order), GROUP):
            group = order[at : at + GROUP]
            training.learn([rows[one] for one in group], list(labels[group]))
    return training.model


def _largest(model: Model, rows: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Per filter the place and the size of its largest answer, ``CHUNK`` words at a time."""
    count = max(1, len(rows))
    places = [np.zeros(FILTERS, dtype=np.int64) for _ in WIDTHS]
    largest = [np.full(FILTERS, -np.inf, dtype=np.float32) for _ in WIDTHS]
    kernel = np.concatenate([one for filters in model.filters for one in filters], axis=1)
    for start in range(0, count, CHUNK):
        here = min(CHUNK, count - start)
        part = rows[start : start + here + PAD]
        vectors = np.zeros((here + PAD, SIZE), dtype=np.float32)
        vectors[: len(part)] = model.table[part[:, 0]] + model.table[part[:, 1]]
        products = vectors @ kernel
        column = 0
        for number, width in enumerate(WIDTHS):
            answers = products[:here, column : column + FILTERS]
            for step in range(1, width):
                column += FILTERS
                answers = answers + products[step : step + here, column : column + FILTERS]
            column += FILTERS
            found = answers.argmax(axis=0)
            values = answers[found, np.arange(FILTERS)]
            better = values > largest[number]
            places[number][better] = found[better] + start
            largest[number][better] = values[better]
    return places, largest


def _slopes(model: Model, rows, label, weight, slopes, touched, pushes) -> float:
    """Adds one text's gradients; the gradient of the bias is returned."""
    places, largest = _largest(model, rows)
    active = np.maximum(np.concatenate(largest) + model.shift, 0.0)
    score = 1.0 / (1.0 + np.exp(-(float(active @ model.weights) + model.bias)))
    error = weight * (score - label)
    back = (error * model.weights * (active > 0)).astype(np.float32)
    slopes[-1] += error * active
    slopes[-2] += back
    # A line per filter and word under it.
    at = np.concatenate([place + step for place, width in zip(places, WIDTHS) for step in range(width)])
    inside = at < len(rows)
    words = rows[at[inside]]
    vectors = np.zeros((len(at), SIZE), dtype=np.float32)
    vectors[inside] = model.table[words[:, 0]] + model.table[words[:, 1]]
    push = []
    for number, filters in enumerate(model.filters):
        own = back[number * FILTERS : (number + 1) * FILTERS]
        for step in range(len(filters)):
            line = len(push) * FILTERS
            slopes[number][step] += vectors[line : line + FILTERS].T * own
            push.append((filters[step] * own).T)
    push = np.concatenate(push)[inside]
    touched += [words[:, 0], words[:, 1]]
    pushes += [push, push]
    return error


def best_threshold(scores: np.ndarray, labels: np.ndarray) -> float:
    """The cut with the best balance of precision and recall, midway to the next score."""
    order = np.argsort(-scores, kind="stable")
    hits = np.cumsum(labels[order])
    balance = 2 * hits / (np.arange(1, len(labels) + 1) + labels.sum())
    at = int(balance.argmax())
    below = scores[order[at + 1]] if at + 1 < len(order) else 0.0
    return float((scores[order[at]] + below) / 2)


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every distinct labelled text that is not held out, as ``words`` with ``toxic`` and ``lang``.

    Of copies one id gives the label and the language. ``draw`` is the hash of the text.
    """
    known = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").filter(
        F.crc32(F.col("doc_id").cast("string")) % 3 != 1
    )
    marked = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang")
    one = F.max(F.struct(F.xxhash64("doc_id", F.lit(3)), "doc_id", "toxic", lang)).alias("one")
    texts = (
        docs.filter("text IS NOT NULL")
        .select("doc_id", "text", "lang")
        # A join of its own, as Spark makes a Bloom filter of a filtered table, not of groups.
        .join(known.select("doc_id"), "doc_id", "left_semi")
        .join(marked, "doc_id")
        .groupBy("text")
        .agg(one)
        .select("text", "one.toxic", "one.lang", F.xxhash64("text").alias("draw"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                words = [_packed(text) for text in part.column(0).to_pylist()]
                lists = pa.array(words, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([lists, *part.columns[1:]], ["words", "toxic", "lang", "draw"])

    return texts.mapInArrow(run, "words array<bigint>, toxic int, lang string, draw bigint")


def _texts(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The table rows of each text of a batch, whose first column is ``words``."""
    words = batch.column(0)
    places, values = words.offsets.to_numpy(), words.values.to_numpy()
    return (_unpacked(values[start:end]) for start, end in zip(places[:-1], places[1:]))


def _seen_by_all(rows: DataFrame) -> np.ndarray:
    """``_seen`` of a whole table; a row per table row, of which there are ``BUCKETS``, is collected."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, BUCKETS), dtype=np.int64)
        for batch in batches:
            seen += _seen(_texts(batch), batch.column(1).to_numpy())
        place = np.flatnonzero(seen.any(axis=0))
        yield pa.RecordBatch.from_pydict({"place": place, "clean": seen[0, place], "toxic": seen[1, place]})

    counts = rows.select("words", "toxic").mapInArrow(run, "place bigint, clean bigint, toxic bigint")
    found = counts.groupBy("place").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow()
    seen = np.zeros((2, BUCKETS), dtype=np.int64)
    for label, name in enumerate(("clean", "toxic")):
        seen[label, found["place"].to_numpy()] = found[name].to_numpy()
    return seen


def _epoch(rows: DataFrame, training: Training, epoch: int, shards: int) -> None:
    """Trains on every row once, a copy of ``training`` per shard, and sets the average of the copies.

    A shard gives the change of each table row that it touched and, under negative places, that
    of all other numbers.
    """
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(training)
    names = [f"c{place}" for place in range(SIZE + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, start = pickle.loads(pickle.dumps(shared.value)), shared.value
        texts, labels = [], []
        for batch in batches:
            for text, label in zip(_texts(batch), batch.column(1).to_pylist()):
                texts.append(text)
                labels.append(label)
                if len(texts) == GROUP:
                    own.learn(texts, labels)
                    texts, labels = [], []
        if texts:
            own.learn(texts, labels)
        if own.steps == start.steps:
            return
        place = np.flatnonzero(own.squares != start.squares)
        table = own.model.table[place].astype(np.float64) - start.model.table[place]
        squares = own.squares[place].astype(np.float64) - start.squares[place]
        flat = own.flat() - start.flat()
        flat = np.pad(flat, (0, -len(flat) % (SIZE + 1))).reshape(-1, SIZE + 1)
        changes = np.concatenate([flat, np.concatenate([table, squares[:, None]], axis=1)])
        changes = np.rint(changes * UNIT).astype(np.int64)
        places = np.concatenate([np.arange(len(flat)) - len(flat), place])
        yield pa.RecordBatch.from_arrays([pa.array(one) for one in (places, *changes.T)], ["place", *names])

    order = F.xxhash64("draw", F.lit(epoch))
    dealt = (
        rows.select("words", "toxic", order.alias("order"))
        .repartitionById(shards, F.pmod(F.xxhash64("order"), F.lit(shards)).cast("int"))
        .sortWithinPartitions("order")
    )
    fields = ", ".join(["place bigint", *(f"{name} bigint" for name in names)])
    # Integral sums are exact; of a mean the driver needs no more digits than the table has.
    means = [(F.sum(name) / F.count(F.lit(1)) / UNIT).cast("float").alias(name) for name in names]
    changes = dealt.mapInArrow(run, fields).groupBy("place").agg(*means)
    # Written, as that lets the shuffled texts and changes of an epoch go before the next.
    changes = written(changes, "toxicity-changes")
    found = changes.orderBy("place").toArrow()
    discard(changes)
    shared.unpersist()
    place = found["place"].to_numpy()
    mean = np.stack([found[name].to_numpy() for name in names], axis=1)
    flat = training.flat()
    training.set_flat(flat + mean[place < 0].ravel()[: len(flat)])
    touched = place[place >= 0]
    training.model.table[touched] += mean[place >= 0, :SIZE]
    training.squares[touched] += mean[place >= 0, SIZE]


def learnt(rows: DataFrame, shard: int = SHARD, seed: int = 7) -> Model:
    """The model learnt from all rows of a table made by ``labelled``."""
    count, toxic = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if toxic in (0, count):
        return _constant(toxic / count if count else 0.0)
    training = _start(np.random.default_rng(seed), _seen_by_all(rows), count - toxic, toxic)
    for epoch in range(EPOCHS):
        _epoch(rows, training, epoch, math.ceil(count / shard))
    return training.model


def lang_thresholds(scores: DataFrame) -> dict[str, float]:
    """The best threshold of each language that has ``FEW`` texts of both classes.

    As ``best_threshold``, of equal scores only all together, without a task per language:
    scores are sorted by ranges, and the rows and hits of a range are added to those before it.
    """
    ranged = (
        scores.groupBy("lang", "score")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("hits"))
        .repartitionByRange("lang", F.desc("score"))
        .withColumn("part", F.spark_partition_id())
    )
    ranged = written(ranged, "toxicity-scores")
    # A row per range and language.
    parts = ranged.groupBy("lang", "part").agg(
        F.sum("n").alias("part_n"), F.sum("hits").alias("part_hits"), F.max("score").alias("top")
    )
    lang = Window.partitionBy("lang")
    before = lang.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "lang",
        "part",
        F.sum("part_n").over(lang).alias("all_n"),
        F.sum("part_hits").over(lang).alias("all_hits"),
        F.coalesce(F.sum("part_n").over(before), F.lit(0)).alias("before_n"),
        F.coalesce(F.sum("part_hits").over(before), F.lit(0)).alias("before_hits"),
        F.lead("top").over(lang.orderBy("part")).alias("next_top"),
    ).filter(F.least(F.col("all_hits"), F.col("all_n") - F.col("all_hits")) >= FEW)
    down = Window.partitionBy("lang", "part").orderBy(F.desc("score"))
    hits = F.col("before_hits") + F.sum("hits").over(down)
    balance = 2 * hits / (F.col("before_n") + F.sum("n").over(down) + F.col("all_hits"))
    below = F.coalesce(F.lead("score").over(down), F.col("next_top"), F.lit(0.0))
    best = (
        ranged.join(parts, ["lang", "part"])
        .select("lang", F.struct(balance.alias("balance"), "score", below.alias("below")).alias("cut"))
        .groupBy("lang")
        .agg(F.max("cut").alias("cut"))
    )
    return {row["lang"]: (row["cut"]["score"] + row["cut"]["below"]) / 2 for row in best.orderBy("lang").collect()}


def _scored_rows(rows: DataFrame, model: Model) -> DataFrame:
    """``lang``, ``toxic`` and ``score`` of rows made by ``labelled``."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one = shared.value
            fixed = one.constant is not None
            scores = np.full(batch.num_rows, one.constant) if fixed else one.score_rows(_texts(batch))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(scores, pa.float64())], ["toxic", "lang", "score"])

    return rows.select("words", "toxic", "lang").mapInArrow(run, "toxic int, lang string, score double")


def fit(docs: DataFrame, labels: DataFrame) -> tuple[Model, dict[str, float]]:
    """The model and the threshold of each language."""
    with with_settings(docs.sparkSession, LABELLED_FIRST):
        rows = written(labelled(docs, labels), "toxicity-texts")
    aside = F.pmod("draw", F.lit(CALIBRATES)) == 0
    model = learnt(rows.filter(~aside))
    return model, lang_thresholds(_scored_rows(rows.filter(aside), model))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``lang`` and ``score`` of every document; only the text is looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(
        "doc_id", F.col("lang").cast("string").alias("lang"), F.coalesce("text", F.lit("")).alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                scores = shared.value.score(part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(scores, pa.float64())],
                    ["doc_id", "lang", "score"],
                )

    fields = [*source.schema.fields[:2], StructField("score", DoubleType())]
    return source.mapInArrow(run, StructType(fields))


def op4_toxicity(spark, sf_dir) -> DataFrame:
    """Every document's score, and whether it passes the common and its language's threshold."""
    docs = table(spark, sf_dir, "documents")
    model, thresholds = fit(docs, table(spark, sf_dir, "labels"))
    threshold = F.lit(THRESHOLD)
    for lang, cut in thresholds.items():
        threshold = F.when(F.col("lang") == lang, F.lit(cut)).otherwise(threshold)
    return scored(docs, model).select(
        "doc_id",
        F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        threshold.alias("lang_threshold"),
        (F.col("score") >= threshold).cast("int").alias("predicted_by_lang"),
    )
