"""Severity of toxic text by cumulative-link ordinal regression (operator 3).

Grades run from 0 (clean) to ``len(cuts)``. One weight per word is shared by all thresholds:

    P(grade > k) = sigmoid(w . x - threshold_k),    expected severity = sum over k of P(grade > k)

The features are words, lower-cased and without marks at both ends, and the beginnings of longer words (``PREFIXES`` letters, written with a
star), as a stem counts whatever follows it. ``x`` is the logarithm of one plus a feature's occurrences, which in a text of more than
``LENGTH`` words are counted per ``LENGTH`` words.

The model is fitted on at most ``FIT_ROWS`` labelled documents (a documented sample: those whose ids hash lowest). The labels are only toxic or not,
so the grades of toxic documents are derived: those of the sample are ranked by their evidence of toxicity (the features whose odds are far
higher in toxic documents) and cut into thirds. Near copies in the sample share one unit of weight, so that
a large group of copies, whose labels are no independent observations, does not make its words look toxic.

Defined cases: a null or empty text has no words and gets the severity of the thresholds alone; a label that is null is not used; labels of
only one kind, or none, give a model that calls nothing toxic (or everything, if all are toxic); an empty table gives no rows; repeated rows
are scored each; other columns are ignored by ``score`` and kept by ``keep_clean``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidemill.llm import cws
from tidemill.llm.words import release, released, slices, text_column, word_codes
from tidemill.session import bound_batches, cut

#: The most labelled documents the model is fitted on.
FIT_ROWS = 8_000
GRADES = 3
PREFIXES = range(3, 10)
LENGTH = 500
MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
#: A word is kept as a feature when its odds differ this much (natural logarithm), beyond this many standard errors.
LEAST_ODDS, LEAST_Z = 1.0, 4.0
PENALTY = 1e-4
STEPS = 400


@dataclass(frozen=True)
class Model:
    words: list[str]
    weights: np.ndarray
    thresholds: np.ndarray

    def probabilities(self, scores: np.ndarray) -> np.ndarray:
        """``P(grade > k)`` for every document and threshold."""
        return 1 / (1 + np.exp(-np.clip(scores[:, None] - self.thresholds[None, :], -40, 40)))


def _plain_words(words: pa.Array) -> pa.Array:
    return pc.utf8_trim(pc.utf8_lower(words), MARKS)


def _with_prefixes(words: pa.Array) -> list[pa.Array]:
    """The words and, for each prefix length, the prefixes of the longer ones (else null)."""
    plain = _plain_words(words)
    lengths = pc.utf8_length(plain)
    star = pa.scalar("*")
    cuts = [pc.if_else(pc.greater(lengths, n), pc.binary_join_element_wise(pc.utf8_slice_codeunits(plain, 0, n), star, ""), None) for n in PREFIXES]
    return [pc.if_else(pc.equal(plain, ""), None, plain), *cuts]


def _counted(features: list[np.ndarray], codes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text, feature, x)`` for the features (given per distinct word, -1 for none) of every text, by text.

    The kinds of features have nothing in common, so they are counted one after the other, which takes the memory of one of them.
    """
    doc = np.repeat(np.arange(len(bounds) - 1, dtype=np.int64), np.diff(bounds))
    found = []
    for feature in features:
        own = feature[codes]
        there = own >= 0
        found.append(np.unique(doc[there] * size + own[there], return_counts=True))
        del own, there
    pairs, counts = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(pairs, kind="stable")
    text, feature = np.divmod(pairs[order], size)
    words = np.diff(bounds)[text]
    return text, feature, np.log1p(counts[order] * np.minimum(1, LENGTH / np.maximum(words, 1)))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``toxic, words, x, sketch`` per labelled document."""
    for batch in batches:
        for part in slices(batch):
            texts = text_column(part)
            codes, bounds, words = word_codes(texts)
            kinds = _with_prefixes(words)
            together = pa.concat_arrays(kinds).dictionary_encode()
            index = pc.fill_null(together.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)
            doc, feature, x = _counted(np.split(index, len(kinds)), codes, bounds, max(1, len(together.dictionary)))
            offsets = pa.array(np.searchsorted(doc, np.arange(len(texts) + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(1).cast(pa.int32()), pa.ListArray.from_arrays(offsets, together.dictionary.take(pa.array(feature))),
                    pa.ListArray.from_arrays(offsets, pa.array(x, pa.float32())), pa.array([s.tobytes() for s in cws.sketch(texts)], pa.binary()),
                ],
                names=["toxic", "words", "x", "sketch"],
            )


def _copy_weights(sketches: np.ndarray, band: int = 8) -> np.ndarray:
    """One over the size of each document's group of near copies: those that share a band of their fingerprint."""
    n = len(sketches)
    group = np.arange(n)
    bands = [np.unique(np.ascontiguousarray(sketches[:, i:i + band]).view(f"V{2 * band}").ravel(), return_inverse=True)[1].ravel() for i in range(0, sketches.shape[1], band)]
    while True:
        before = group
        for keys in bands:
            least = np.full(n, n)
            np.minimum.at(least, keys, group)
            group = np.minimum(group, least[keys])
        if (group == before).all():
            break
    return 1 / np.bincount(group, minlength=n)[group]


def _grades(toxic: np.ndarray, evidence: np.ndarray, grades: int) -> np.ndarray:
    out = np.zeros(len(toxic), np.int64)
    shares = evidence[toxic]
    if len(shares):
        cuts = np.quantile(shares, np.arange(1, grades) / grades)
        out[toxic] = 1 + np.searchsorted(cuts, shares, side="left")
    return out


def _regress(row: np.ndarray, column: np.ndarray, value: np.ndarray, grade: np.ndarray, weight: np.ndarray, features: int, grades: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by Adam on the penalised likelihood; ``gaps`` are logarithms, which keeps the thresholds in order."""
    n, total = len(grade), weight.sum()
    w, first, gaps = np.zeros(features), 2.0, np.zeros(grades - 1)
    moment, square = np.zeros(features + grades), np.zeros(features + grades)
    for step in range(1, STEPS + 1):
        thresholds = first + np.concatenate([[0], np.cumsum(np.exp(gaps))])
        score = np.bincount(row, w[column] * value, n)
        above = 1 / (1 + np.exp(-np.clip(score[:, None] - thresholds[None, :], -40, 40)))
        ladder = np.concatenate([np.ones((n, 1)), above, np.zeros((n, 1))], axis=1)
        slope = ladder * (1 - ladder)
        at = np.arange(n)
        chance = np.maximum(ladder[at, grade] - ladder[at, grade + 1], 1e-12)
        scale = weight / (chance * total)
        by_score = -(slope[at, grade] - slope[at, grade + 1]) * scale
        by_threshold = np.zeros((n, grades + 2))
        by_threshold[at, grade] += slope[at, grade] * scale
        by_threshold[at, grade + 1] -= slope[at, grade + 1] * scale
        each = by_threshold[:, 1:-1].sum(axis=0)
        tails = np.cumsum(each[::-1])[::-1]
        gradient = np.concatenate([np.bincount(column, by_score[row] * value, features) + PENALTY * w, tails[:1], tails[1:] * np.exp(gaps)])
        moment = 0.9 * moment + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        move = 0.1 * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
        w, first, gaps = w - move[:features], first - move[features], gaps - move[features + 1:]
    return w, first + np.concatenate([[0], np.cumsum(np.exp(gaps))])


def fit(docs: DataFrame, labels: DataFrame, *, rows: int = FIT_ROWS, grades: int = GRADES) -> Model:
    """The model of at most ``rows`` labelled documents of ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``.

    Features are counted and chosen by Spark; the driver gets the sample's fingerprints and the occurrences of the chosen features.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    chosen = labels.select("doc_id", "toxic").filter("doc_id is not null and toxic is not null")
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(rows)
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "text")
    seen = joined.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic", "text").limit(rows)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sample = seen.repartition(parts).mapInArrow(released(_features), "toxic int, words array<string>, x array<float>, sketch binary")
    sample = cut(sample.withColumn("row", F.monotonically_increasing_id()))

    known = sample.select("row", "toxic", "sketch").orderBy("row").toArrow().combine_chunks()
    number = known.column("row").to_numpy()
    toxic = known.column("toxic").to_numpy().astype(np.int64) == 1
    if not toxic.any() or toxic.all():
        return Model([], np.empty(0), np.arange(grades) + (-40.0 if toxic.any() else 40.0))
    weight = _copy_weights(np.stack([np.frombuffer(s, np.uint16) for s in known.column("sketch").to_pylist()]))

    weights = spark.createDataFrame(pa.table({"row": number, "weight": weight, "bad": toxic}))
    every = sample.select("row", F.explode(F.arrays_zip("words", "x")).alias("f")).select("row", F.col("f.words").alias("word"), F.col("f.x").alias("x"))
    counted = every.join(F.broadcast(weights), "row").groupBy("word").agg(F.sum(F.when(F.col("bad"), F.col("weight")).otherwise(0.0)).alias("t"), F.sum(F.when(~F.col("bad"), F.col("weight")).otherwise(0.0)).alias("c"))
    cells = [F.col("t") + 0.5, float(weight[toxic].sum()) - F.col("t") + 0.5, F.col("c") + 0.5, float(weight[~toxic].sum()) - F.col("c") + 0.5]
    odds = F.log(cells[0]) - F.log(cells[1]) - F.log(cells[2]) + F.log(cells[3])
    error = F.sqrt(sum(1 / c for c in cells))
    telling = counted.select("word", odds.alias("odds"), error.alias("error")).filter((F.abs("odds") >= LEAST_ODDS) & (F.abs("odds") >= LEAST_Z * F.col("error")))
    telling = cut(telling.select("word", "odds"))
    words = telling.orderBy("word").toArrow().combine_chunks()
    found = every.join(F.broadcast(telling.select("word")), "word").orderBy("row", "word").toArrow().combine_chunks()  # the sample bounds both

    names = words.column("word").to_pylist()
    index = {w: i for i, w in enumerate(names)}
    row = np.searchsorted(number, found.column("row").to_numpy())
    column = np.fromiter((index[w] for w in found.column("word").to_pylist()), np.int64, found.num_rows)
    x = found.column("x").to_numpy().astype(np.float64)
    evidence = np.bincount(row, np.maximum(words.column("odds").to_numpy(), 0)[column] * x, len(toxic)) if names else np.zeros(len(toxic))
    w, thresholds = _regress(row, column, x, _grades(toxic, evidence, grades), weight, len(names), grades)
    return Model(names, w, thresholds)


def _scores(model: Model, texts: pa.Array) -> np.ndarray:
    out = np.zeros(len(texts))
    if not model.words:
        return out
    codes, bounds, words = word_codes(texts)
    known = pa.array(model.words)
    for kind in _with_prefixes(words):
        feature = pc.fill_null(pc.index_in(kind, value_set=known, skip_nulls=True), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        text, feature, x = _counted([feature], codes, bounds, len(known))
        out += np.bincount(text, model.weights[feature] * x, len(texts))
    return out


def _scored(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                above = model.probabilities(_scores(model, text_column(part)))
                chance = -np.diff(np.concatenate([np.ones((len(above), 1)), above, np.zeros((len(above), 1))], axis=1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(above.sum(axis=1)), pa.array(chance.argmax(axis=1), pa.int32()), pa.array(above[:, 0]), pa.array(above[:, 0] >= 0.5)],
                    names=["doc_id", "severity", "grade", "p_toxic", "toxic"],
                )

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs(doc_id, text)``: ``doc_id, severity`` (expected grade), ``grade`` (the likeliest), ``p_toxic, toxic``."""
    bound_batches(docs.sparkSession)
    rows = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    return rows.mapInArrow(released(_scored(model)), "doc_id long, severity double, grade int, p_toxic double, toxic boolean")


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not toxic, with all their columns. Only texts go to Python, and a flag comes back."""
    bound_batches(docs.sparkSession)

    @F.arrow_udf("boolean")
    def is_clean(texts: pa.Array) -> pa.Array:
        parts = slices(pa.RecordBatch.from_arrays([texts], names=["text"]))
        found = [model.probabilities(_scores(model, text_column(part)))[:, 0] < 0.5 for part in parts]
        release()
        return pa.array(np.concatenate(found) if found else np.empty(0, bool))

    return docs.filter(is_clean(F.col("text").cast("string")))
