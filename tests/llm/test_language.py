"""Language models against plain Kneser-Ney, and predictions against held-out labels."""

from __future__ import annotations

import math
import random
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import SF_DIR
from tidemill.llm import kneser_ney as kn

SCHEMA = "doc_id long, text string, lang string"


def plain_runs(text):
    runs, run = [], []
    for c in "".join(c.lower() for c in text) + " ":
        if unicodedata.category(c)[0] in "LM":
            run.append(c)
        elif run:
            runs.append(run)
            run = []
    return runs


class Plain:
    """Interpolated Kneser-Ney as the formula says it, over runs that begin and end with a boundary."""

    def __init__(self, texts, order):
        self.order = order
        raw = defaultdict(Counter)
        for text in texts:
            for run in plain_runs(text):
                seq = ["", *run, ""]
                for i in range(1, len(seq)):
                    for n in range(1, order + 1):
                        if i - n + 1 >= 0:
                            raw[n][tuple(seq[i - n + 1:i + 1])] += 1
        self.counts = {}
        for n in range(1, order + 1):
            if n == order:
                self.counts[n] = raw[n]
                continue
            before = Counter(g[1:] for g in raw[n + 1])
            self.counts[n] = {g: c if g[0] == "" and n > 1 else before[g] for g, c in raw[n].items()}
            if n == 1:
                self.counts[n] = {g: before[g] for g in raw[n]}
        self.alphabet = len({c for g in raw[1] for c in g}) + 1
        self.discount, self.kinds, self.sums = {}, {}, {}
        for n, counts in self.counts.items():
            ones, twos = (sum(v == k for v in counts.values()) for k in (1, 2))
            self.discount[n] = min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones else 0.5
            self.kinds[n], self.sums[n] = Counter(g[:-1] for g in counts), Counter()
            for g, c in counts.items():
                self.sums[n][g[:-1]] += c

    def chance(self, history, symbol, n):
        if n == 0:
            return 1 / self.alphabet
        lower = self.chance(history[1:] if len(history) else history, symbol, n - 1)
        h = tuple(history)
        if not self.sums[n][h]:
            return lower
        d = self.discount[n]
        return max(self.counts[n].get((*h, symbol), 0) - d, 0) / self.sums[n][h] + d * self.kinds[n][h] / self.sums[n][h] * lower

    def bits(self, text):
        total = symbols = 0
        for run in plain_runs(text):
            seq = ["", *run, ""]
            for i in range(1, len(seq)):
                n = min(self.order, i + 1)
                total -= math.log2(self.chance(seq[i - n + 1:i], seq[i], n))
                symbols += 1
        return total / max(symbols, 1), symbols


TEXTS = ["The cat, the hat; don't 'tis 42 naïve été", "thé cats athat the the", "ΑΒΓ αβγ ΣΑΣ", "a", "", "12 !", "́ x"]


@pytest.mark.parametrize("order", [1, 2, 3, 5])
def test_entropies_equal_the_formula(order):
    language = kn.learn("x", pa.array(TEXTS), order)
    model = kn.Model([language], order)
    asked = [*TEXTS, "the unseen ζ words", "cat " * 50, "zzz"]
    bits, symbols, lettered = kn.entropies(model, pa.array(asked))
    plain = Plain(TEXTS, order)
    for i, text in enumerate(asked):
        want, n = plain.bits(text)
        assert symbols[i] == n
        assert lettered[i] == any(unicodedata.category(c)[0] == "L" for c in text)
        assert bits[i, 0] == pytest.approx(want, rel=1e-5)


@pytest.mark.parametrize("order", [2, 4])
def test_chances_add_up_to_one(order):
    plain = Plain(TEXTS, order)
    symbols = [*{c for g in plain.counts[1] for c in g}]
    for history in ([""], ["", "t"], ["t", "h"], ["q"]):
        n = min(order, len(history) + 1)
        h = history[len(history) - n + 1:]
        assert sum(plain.chance(h, s, n) for s in symbols) + plain.chance(h, "\x00", n) == pytest.approx(1)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = kn.fit(docs)
    rows = kn.predict(docs, model).join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
    held = [r for r in rows if r.held_out and r.lang]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)


def test_rejection_and_calibration(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = kn.fit(docs)
    rng = random.Random(1)
    strange = ["".join(rng.choice("qxzjvkwyхжфщ") + rng.choice(["", " "]) for _ in range(400)) for _ in range(20)]
    df = spark.createDataFrame(list(enumerate(strange)), "doc_id long, text string")
    rows = kn.predict(df, model, reject=True).collect()
    assert all(r.rejected and r.lang_pred == "und" for r in rows)
    kept = kn.predict(df, model).collect()
    assert all(r.rejected and r.lang_pred != "und" for r in kept)
    every = kn.predict(docs, model).collect()
    assert sum(r.rejected for r in every) <= 0.03 * len(every)
    # The scores mean what they say: their mean over labelled documents is near the share that is right.
    joined = kn.predict(docs, model).join(docs.filter("lang is not null").select("doc_id", "lang"), "doc_id").collect()
    right = np.mean([r.lang == r.lang_pred for r in joined])
    assert abs(np.mean([r.score for r in joined]) - right) < 0.03


def test_defined_cases(spark):
    rows = [(i, "alpha beta gamma delta " * 5, "aa") for i in range(40)] + [(100 + i, "ыва олдж фыв " * 5, "bb") for i in range(40)]
    rows += [(None, "alpha", "aa"), (200, None, "aa"), (201, "", None), (202, "123 !? ́", "bb"), (203, "alpha beta", None), (203, "alpha beta", None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("held_out", F.lit(5)).withColumn("bits", F.lit("x"))
    found = kn.predict(df, kn.fit(df)).collect()
    assert len(found) == len(rows)
    by_id = defaultdict(list)
    for r in found:
        by_id[r.doc_id].append(r)
    for i in (200, 201, 202):
        assert [(r.lang_pred, r.score) for r in by_id[i]] == [("und", 0.0)]
    assert [(r.lang_pred, r.held_out) for r in by_id[None]] == [("aa", False)]
    assert len({(r.lang_pred, r.score) for r in by_id[203]}) == 1 and len(by_id[203]) == 2
    assert all(r.lang_pred == "bb" for i in range(100, 140) for r in by_id[i])
    # Nothing to learn from, and nothing to predict.
    none = df.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in kn.predict(none, kn.fit(none)).collect()} == {"und"}
    empty = df.limit(0)
    assert kn.predict(empty, kn.fit(empty)).collect() == []


def test_long_texts_are_read_whole(spark):
    rows = [(i, "alpha beta gamma " * 9, "aa") for i in range(30)] + [(100 + i, "ыва олдж " * 9, "bb") for i in range(30)]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = kn.fit(docs)
    long = spark.createDataFrame([(1, "alpha beta " * 2000 + "олдж ыва " * 200_000)], "doc_id long, text string")
    assert kn.predict(long, model).first().lang_pred == "bb"
