"""Language of a text by interpolated Kneser-Ney models of letters (operator 12).

A text is its runs of letters (with combining marks), lower-cased; each run is a sequence that starts and ends with a boundary, and a letter
depends on at most ``ORDER - 1`` symbols before it, back to the run's boundary. A language's model keeps for each order the hashes of its
sequences in ascending order beside their discounted shares, and the hashes of its histories beside the weights of the next lower order. A
text goes to the language with the least cross-entropy, its bits per symbol.

Calibration uses labelled documents that no model has seen. The score is the chance of the language chosen, a softmax of the cross-entropies
times the root of the length, with the temperature that makes the labels likeliest. A text is ``rejected`` when its cross-entropy, for
its length, is further above the mean of its language than all but ``REJECT`` of the labelled documents: it is then in no language
that was learnt, and ``predict(..., reject=True)`` answers ``und``.

The fit takes at most ``FIT_DOCS`` documents, shared by at most ``FIT_LANGUAGES`` languages (the most frequent ones), with one window of at most
``FIT_CHARS`` code points of each, and a fifth as many for the calibration; all other work covers all rows and whole texts. A model's size is
bounded by that sample, which is why it may be sent to all tasks.

Defined cases: a text that is null or has no letter, and every text if nothing was learnt, is ``und`` with score 0; a document without id is not held
out and not learnt from; equal rows get equal answers; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemill.llm.words import rows_of, slices, text_column, word_codes
from tidemill.session import cut

ORDER = 5
FIT_DOCS = 8_000
FIT_LANGUAGES = 200
FIT_CHARS = 2_000
REJECT = 0.001
UNKNOWN = "und"
#: Every document whose number modulo this is 0 is held out; those with 1 calibrate.
FOLDS = 5

_BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Runs:
    """The symbols of the runs of letters of some words: 0 for a boundary, else the letter's code point."""

    symbols: np.ndarray
    #: The word of each symbol that is predicted, and its place in ``symbols``.
    word: np.ndarray
    place: np.ndarray
    #: Symbols before each place, back to and with the boundary.
    reach: np.ndarray
    #: Words with at least one letter.
    lettered: np.ndarray


def _categories(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each code point belongs to a run, and whether it is a letter."""
    distinct, at = np.unique(points, return_inverse=True)
    first = np.array([unicodedata.category(chr(p))[0] for p in distinct.tolist()], "U1")
    return np.isin(first, ["L", "M"])[at], (first == "L")[at]


def runs(words: pa.Array) -> Runs:
    lowered = pc.utf8_lower(words)
    lengths = pc.utf8_length(lowered).to_numpy(zero_copy_only=False).astype(np.int64)
    text = "".join(lowered.to_numpy(zero_copy_only=False).tolist())
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    word = np.repeat(np.arange(len(words)), lengths)
    inside, letter = _categories(points)
    same = np.zeros(len(points), bool)
    same[1:] = inside[1:] & inside[:-1] & (word[1:] == word[:-1])
    starts = np.flatnonzero(inside & ~same)
    kept = np.flatnonzero(inside)
    ends = np.searchsorted(kept, np.append(starts, len(points)))
    counts = np.diff(ends)
    # Run i takes counts[i] + 1 places, and one boundary more stands before all of them.
    begin = np.cumsum(counts + 1) - (counts + 1)
    symbols = np.zeros(int((counts + 1).sum()) + 1, np.uint32)
    symbols[rows_of(begin + 1, counts)] = points[kept]
    place = rows_of(begin + 1, counts + 1)
    return Runs(
        symbols, np.repeat(word[starts], counts + 1), place, rows_of(np.ones(len(starts), np.int64), counts + 1),
        np.bincount(word[letter], minlength=len(words)) > 0,
    )


def _hashes(r: Runs, order: int) -> list[np.ndarray]:
    """``out[n][i]``: the hash of the ``n`` symbols that end at place ``i``; ``out[0]`` is all 0."""
    with np.errstate(over="ignore"):
        one = r.symbols.astype(np.uint64) + np.uint64(1)
        out, factor = [np.zeros(len(one), np.uint64)], np.uint64(1)
        for n in range(1, order + 1):
            grown = out[-1].copy()
            grown[n - 1:] += (one[: len(one) - n + 1] * _BASE) * factor
            out.append(grown)
            factor = np.uint64((int(factor) * 0xD1342543DE82EF95) % (1 << 64))
    return out


@dataclass
class Language:
    """``grams[n], shares[n]``: sequences of ``n + 1`` symbols; ``histories[n], weights[n]``: of the ``n`` symbols before the last."""

    name: str
    grams: list[np.ndarray]
    shares: list[np.ndarray]
    histories: list[np.ndarray]
    weights: list[np.ndarray]
    alphabet: int


def learn(name: str, texts: pa.Array, order: int = ORDER) -> Language:
    """The Kneser-Ney model of some texts."""
    codes, _, words = word_codes(texts)
    r = runs(words)
    times = np.bincount(codes, minlength=len(words))[r.word]
    hashes = _hashes(r, order)
    grams, shares, histories, weights = [], [], [], []
    longer: tuple[np.ndarray, np.ndarray] | None = None  # distinct sequences of one symbol more: the hash of their end, and of themselves
    for n in range(order, 0, -1):
        able = r.reach >= n - 1
        at = r.place[able]
        found, where, back = np.unique(hashes[n][at], return_index=True, return_inverse=True)
        counts = np.bincount(back, times[able], len(found)) if len(found) else np.empty(0)
        if longer is not None:
            # Sequences from a boundary on have nothing before them and keep their counts; others count the symbols seen before them.
            inner = r.reach[able][where] >= n
            before = np.bincount(np.searchsorted(found, longer[0]), minlength=len(found))
            counts = np.where(inner, before, counts)
        here = at[where]
        history = hashes[n - 1][here - 1]
        longer = (hashes[n - 1][here], found) if n > 1 else None
        ones, twos = (counts == 1).sum(), (counts == 2).sum()
        discount = min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones else 0.5
        known, of = np.unique(history, return_inverse=True)
        totals = np.bincount(of, counts, len(known))
        kinds = np.bincount(of, minlength=len(known))
        grams.append(found)
        shares.append(((counts - discount) / totals[of]).astype(np.float32))
        histories.append(known)
        weights.append((discount * kinds / totals).astype(np.float32))
    alphabet = len(np.unique(r.symbols)) + 1
    return Language(name, grams[::-1], shares[::-1], histories[::-1], weights[::-1], alphabet)


def _found(keys: np.ndarray, known: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(known):
        return np.zeros(len(keys), bool), np.zeros(len(keys))
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    hit = known[at] == keys
    return hit, np.where(hit, values[at], 0.0)


def log_chances(language: Language, hashes: list[np.ndarray], place: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """The logarithm to base 2 of the chance of the symbol at each place."""
    chance = np.full(len(place), 1.0 / language.alphabet)
    for n in range(1, len(language.grams) + 1):
        at = np.flatnonzero(reach >= n - 1)
        seen, weight = _found(hashes[n - 1][place[at] - 1], language.histories[n - 1], language.weights[n - 1])
        _, share = _found(hashes[n][place[at]], language.grams[n - 1], language.shares[n - 1])
        chance[at] = np.where(seen, share + weight * chance[at], chance[at])
    return np.log2(chance)


@dataclass
class Model:
    languages: list[Language]
    order: int = ORDER
    temperature: float = 1.0
    #: Per language: the mean cross-entropy, and the farthest step above it, times the root of the length.
    mean: np.ndarray | None = None
    reach: np.ndarray | None = None


def entropies(model: Model, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(bits, symbols, lettered)``: the cross-entropy of each text in each language, its symbols, and whether it has a letter."""
    codes, bounds, words = word_codes(texts)
    text = np.repeat(np.arange(len(texts)), np.diff(bounds))
    r = runs(words)
    per_word = np.bincount(r.word, minlength=len(words))
    symbols = np.bincount(text, per_word[codes], len(texts))
    lettered = np.bincount(text, r.lettered[codes], len(texts)) > 0
    hashes = _hashes(r, model.order)
    # A symbol's chance depends on the longest sequence that ends with it, so each distinct one is looked up once.
    longest = hashes[model.order][r.place]
    for n in range(1, model.order - 1):
        longest = np.where(r.reach == n, hashes[n + 1][r.place], longest)
    _, where, back = np.unique(longest, return_index=True, return_inverse=True)
    place, reach = r.place[where], r.reach[where]
    bits = np.zeros((len(texts), len(model.languages)))
    for i, language in enumerate(model.languages):
        of_word = np.bincount(r.word, -log_chances(language, hashes, place, reach)[back], len(words))
        bits[:, i] = np.bincount(text, of_word[codes], len(texts))
    return bits / np.maximum(symbols, 1)[:, None], symbols, lettered


def _softmax(bits: np.ndarray, symbols: np.ndarray, temperature: float) -> np.ndarray:
    steps = -(bits - bits.min(axis=1, keepdims=True)) * np.sqrt(symbols)[:, None] / temperature
    chance = np.exp(np.maximum(steps, -700))
    return chance / chance.sum(axis=1, keepdims=True)


def calibrate(model: Model, bits: np.ndarray, symbols: np.ndarray, truth: np.ndarray, reject: float = REJECT) -> Model:
    """The model with its temperature and its limits for rejection; ``truth`` holds the place of each document's language."""
    if not len(truth):
        model.mean, model.reach = np.full(len(model.languages), np.inf), np.zeros(len(model.languages))
        return model
    trials = np.geomspace(0.01, 30, 120)
    losses = [-np.log(np.maximum(_softmax(bits, symbols, t)[np.arange(len(truth)), truth], 1e-12)).mean() for t in trials]
    model.temperature = float(trials[int(np.argmin(losses))])
    own = bits[np.arange(len(truth)), truth]
    mean = np.array([own[truth == i].mean() if (truth == i).any() else np.inf for i in range(len(model.languages))])
    steps = np.where(np.isfinite(mean[truth]), own - mean[truth], 0) * np.sqrt(symbols)
    model.mean = mean
    model.reach = np.array([np.quantile(steps[truth == i], 1 - reject) if (truth == i).any() else 0.0 for i in range(len(model.languages))])
    return model


def _fold(docs: DataFrame) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(FOLDS))


def _sample(labelled: DataFrame, shares: dict[str, int], quota: int, chars: int) -> DataFrame:
    """About ``quota`` documents of each language, in the order of a hash: ``lang, text`` with a window of each text."""
    spark = labelled.sparkSession
    drawn = F.xxhash64("doc_id", F.lit("language"))
    # Twice the quota is let through, whatever the table's size, so the ranking sees a bounded number of rows.
    limits = spark.createDataFrame([(k, min(1.0, 2 * quota / n)) for k, n in shares.items()], "lang string, rate double")
    rows = labelled.withColumn("drawn", drawn).join(F.broadcast(limits), "lang")
    rows = rows.filter(F.pmod("drawn", F.lit(1 << 40)) < F.col("rate") * float(1 << 40))
    start = 1 + F.pmod(F.xxhash64("drawn"), F.greatest(F.lit(1), F.char_length("text") - chars + 1))
    rows = rows.select("lang", "doc_id", "drawn", F.substring(F.col("text"), start.cast("int"), F.lit(chars)).alias("text"))
    order = Window.partitionBy("lang").orderBy("drawn", "doc_id", "text")
    return rows.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= quota).select("lang", "text")


_LISTS = ("grams", "shares", "histories", "weights")
_KINDS = dict(zip(_LISTS, (np.uint64, np.float32, np.uint64, np.float32)))


def _learnt(order: int):
    def run(table: pa.Table) -> pa.Table:
        model = learn(table.column("lang")[0].as_py(), text_column(table.combine_chunks().to_batches()[0]), order)
        return pa.table(
            {"lang": [model.name], "alphabet": pa.array([model.alphabet], pa.int32())}
            | {k: pa.array([[x.tobytes() for x in getattr(model, k)]], pa.list_(pa.binary())) for k in _LISTS}
        )

    return run


def _measured(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                bits, symbols, lettered = entropies(model, text_column(part))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(list(bits), pa.list_(pa.float64())), pa.array(np.where(lettered, symbols, 0))], names=["lang", "bits", "symbols"])

    return run


def fit(docs: DataFrame, *, docs_limit: int = FIT_DOCS, chars: int = FIT_CHARS, languages: int = FIT_LANGUAGES, order: int = ORDER, reject: float = REJECT) -> Model:
    """The models of ``docs(doc_id, text, lang)``, from the labelled documents that are not held out."""
    labelled = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), _fold(docs).alias("fold"))
    labelled = labelled.filter("lang is not null and text is not null and fold <> 0")
    counted = labelled.groupBy("lang", F.expr("fold = 1").alias("second")).count()
    top = counted.groupBy("lang").agg(F.sum("count").alias("n")).orderBy(F.desc("n"), "lang").limit(languages)
    shares: dict[bool, dict[str, int]] = {False: {}, True: {}}
    for row in counted.join(F.broadcast(top), "lang").collect():
        shares[row.second][row.lang] = row["count"]
    if not shares[False]:
        return Model([], order)
    quota = max(1, docs_limit // len(shares[False]))
    sample = _sample(labelled.filter("fold <> 1"), shares[False], quota, chars)
    schema = "lang string, alphabet int, " + ", ".join(f"{k} array<binary>" for k in _LISTS)
    learnt = sample.groupBy("lang").applyInArrow(_learnt(order), schema).orderBy("lang").collect()
    model = Model([Language(r.lang, **{k: [np.frombuffer(x, _KINDS[k]) for x in r[k]] for k in _LISTS}, alphabet=r.alphabet) for r in learnt], order)
    place = {language.name: i for i, language in enumerate(model.languages)}
    known = {k: n for k, n in shares[True].items() if k in place}
    if not known:
        return calibrate(model, np.empty((0, len(place))), np.empty(0), np.empty(0, np.int64), reject)
    second = _sample(labelled.filter("fold = 1"), known, max(1, quota // FOLDS), chars)
    rows = second.mapInArrow(_measured(model), "lang string, bits array<double>, symbols double").filter("symbols > 0").collect()
    rows.sort(key=lambda r: (r.lang, r.symbols, r.bits))
    bits = np.array([r.bits for r in rows]).reshape(len(rows), len(place))
    return calibrate(model, bits, np.array([r.symbols for r in rows]), np.array([place[r.lang] for r in rows], np.int64), reject)


def _predicted(model: Model, reject: bool):
    names = pa.array([language.name for language in model.languages] + [UNKNOWN])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                n = part.num_rows
                choice, score, bits_of, far = np.full(n, len(names) - 1), np.zeros(n), np.full(n, np.nan), np.zeros(n, bool)
                if model.languages:
                    bits, symbols, lettered = entropies(model, text_column(part))
                    best = bits.argmin(axis=1)
                    least = bits[np.arange(n), best]
                    chance = _softmax(bits, symbols, model.temperature)[np.arange(n), best]
                    far = lettered & ((least - model.mean[best]) * np.sqrt(symbols) > model.reach[best])
                    choice = np.where(lettered & ~(far & reject), best, choice)
                    score, bits_of = np.where(lettered, chance, 0.0), np.where(lettered, least, np.nan)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), names.take(pa.array(choice)), pa.array(score), pa.array(bits_of, mask=np.isnan(bits_of)), pa.array(far)],
                    names=["doc_id", "held_out", "lang_pred", "score", "cross_entropy", "rejected"],
                )

    return run


def predict(docs: DataFrame, model: Model, *, reject: bool = False) -> DataFrame:
    """``docs(doc_id, text)``: ``doc_id, held_out, lang_pred, score, cross_entropy`` (bits per symbol) and ``rejected``."""
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(_fold(docs) == 0, F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_predicted(model, reject), "doc_id long, held_out boolean, lang_pred string, score double, cross_entropy double, rejected boolean")
