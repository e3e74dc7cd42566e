"""Phrases against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import lower
from tidemill.llm import collocations

SCHEMA = "doc_id long, lang string, text string"


def plain(rows, min_count=10, max_words=3, top=2000, inside=50):
    counts, totals = {}, Counter()
    for _, lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, max_words + 1):
                for i in range(len(words) - size + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i:i + size])] += 1
    out = set()
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        kept = []
        for p, a in found.items():
            if any(len(q) > len(p) and 100 * g >= inside * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, g in found.items()):
                continue
            cuts = [(1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return out


def texts(seed=1, n=300):
    rng = random.Random(seed)
    words = ["a", "B", "the", "é", "x-y", "Ünder", "new", "york", "city", "the end", " ", "1", "z" * 40]
    gaps = [" ", "  ", "\t", ". ", ",", "\n", "\r\n", " ; ", "\x0b"]
    rows = []
    for i in range(n):
        body = "".join(rng.choice(words) + rng.choice(gaps[:3] * 4 + gaps) for _ in range(rng.randint(0, 60)))
        rows.append((i, rng.choice(["en", "de", None, "und", "EN"]), body))
    rows += [(900, "en", None), (901, "en", ""), (902, "de", " .,; \n"), (903, "one", "New York City " * 12), (903, "one", "New York City " * 12)]
    return rows


def got(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return {tuple(r) for r in df.collect()}


def test_equals_plain_counting(spark):
    rows = texts()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumn("word", F.lit(1)).withColumn("chunk", F.lit(2)).withColumn("f", F.lit("f"))
    assert got(collocations.collocations(df)) == plain(rows)


def test_longer_phrases_few_places_and_small_parts(spark, monkeypatch):
    rows = texts(2, 120)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    monkeypatch.setattr(collocations, "RANK_PARTS", 2)
    assert got(collocations.collocations(df, min_count=3, max_words=5, top=7, inside=80)) == plain(rows, 3, 5, 7, 80)
    assert got(collocations.collocations(df, min_count=2, max_words=2, top=10**6)) == plain(rows, 2, 2, 10**6)


def test_empty_tables(spark):
    for rows in ([], [(1, None, None)], [(1, "en", "one two")]):
        df = spark.createDataFrame(rows, SCHEMA)
        assert got(collocations.collocations(df)) == set()


@pytest.mark.parametrize("spread", [40, 3000, 10**6])
def test_tiles_and_coordinates(spread):
    """Full tiles, sorted coordinates and both together."""
    rng = np.random.default_rng(spread)
    ids = np.concatenate([rng.integers(0, 40, 400_000), rng.integers(0, spread, 50_000)]).astype(np.int32)
    ids[rng.integers(0, len(ids), 9_000)] = -1
    keys, counts = collocations.pair_counts(ids)
    want = Counter((a, b) for a, b in zip(ids[:-1].tolist(), ids[1:].tolist()) if a >= 0 and b >= 0)
    assert dict(zip(keys.tolist(), counts.tolist())) == {a << 32 | b: n for (a, b), n in want.items()}
    assert (np.diff(keys) > 0).all()


def test_scores_past_64_bits(spark):
    rows = [(10**12, 10**12 + 7, 10**12 + 9), (999_999_999_999_999, 999_999_999_999_999, 999_999_999_999_999), (10, 3 * 10**14, 5 * 10**14), (10**9, 10**9 + 1, 2 * 10**9)]
    df = spark.createDataFrame(rows, "a long, l long, r long").select("a", "l", "r", collocations.score_of(F.col("a"), F.col("l"), F.col("r")).alias("s"))
    assert all(r.s == 1_000_000 * r.a * r.a // (r.l * r.r) for r in df.collect())
