"""Pairs of forms that the scorers may accept, from cells of forms that share a key; bounded sides matched and settled inside tasks.

A cell holds the forms that offer one key. All its pairs are looked at together, on counts of letters: insertions and deletions between two texts are at
least as many as the letters one has more of than the other, and a text that lies in another one nearly whole has nearly all its letters
there. So a pair costs some bytes of arithmetic for each key it shares, and what is left are the pairs worth a score, once each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemill.functions import fuzzy
from tidemill.operators.edits import LONGEST, EditTrie

#: Letters are counted in this many classes; classes only make counts more alike.
CLASSES = 32
#: Forms of a cell that are compared with as many others at once.
BLOCK = 512


class Letters:
    """Counts of the letters of some forms, spaces apart, as they are and with each word once."""

    def __init__(self, forms: list[str]):
        self.size = np.array([len(f) for f in forms], np.float32)
        words = [" ".join(sorted(set(f.split()))) for f in forms]
        self.word_size = np.array([len(w) for w in words], np.float32)
        self.counts = _counted(forms)
        differ = [i for i, (f, w) in enumerate(zip(forms, words)) if len(w) != len(f)]
        self.word_counts = self.counts
        if differ:
            self.word_counts = self.counts.copy()
            self.word_counts[differ] = _counted([words[i] for i in differ])

    def part(self, rows) -> "Letters":
        out = object.__new__(Letters)
        out.size, out.word_size = self.size[rows], self.word_size[rows]
        out.counts = self.counts[rows]
        out.word_counts = out.counts if self.word_counts is self.counts else self.word_counts[rows]
        return out


def _counted(forms: list[str]) -> np.ndarray:
    lengths = np.array([len(f) for f in forms], np.int64)
    points = np.frombuffer("".join(forms).encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = (points * np.uint32(2654435761)) >> np.uint32(27)
    row = np.repeat(np.arange(len(forms)), lengths)
    letter = points != 32
    flat = np.bincount(row[letter] * CLASSES + kind[letter], minlength=len(forms) * CLASSES)
    return np.minimum(flat, 30_000).astype(np.int16).reshape(len(forms), CLASSES)


def may_be_alike(a: Letters, b: Letters, threshold: int, scorer: str) -> np.ndarray:
    """For every pair of an ``a`` and a ``b`` whether their letters allow a score of the threshold, words in common apart."""
    bound = threshold - 0.5
    size_a, size_b = a.size[:, None], b.size[None, :]
    more = np.zeros((len(a.size), len(b.size)), np.float32)
    less = np.zeros_like(more)
    for c in range(CLASSES):
        step = a.counts[:, c, None] - b.counts[None, :, c]
        more += np.maximum(step, 0)
        less += np.maximum(-step, 0)
    if scorer == "levenshtein":  # an edit takes away one letter too many and adds one too few at most
        return np.maximum(more, less) <= np.maximum(size_a, size_b) * (1 - threshold / 100) + 1e-3
    total = size_a + size_b
    near = more + less <= total * (1 - bound / 100) + 1e-3
    if scorer == "ratio":
        return near
    if a.word_counts is a.counts and b.word_counts is b.counts:
        more_words, less_words = more, less
    else:
        more_words, less_words = np.zeros_like(more), np.zeros_like(more)
        for c in range(CLASSES):
            step = a.word_counts[:, c, None] - b.word_counts[None, :, c]
            more_words += np.maximum(step, 0)
            less_words += np.maximum(-step, 0)
    words = a.word_size[:, None] + b.word_size[None, :]
    near |= more_words + less_words <= words * (1 - bound / 95) + 1e-3
    short, long = np.minimum(size_a, size_b), np.maximum(size_a, size_b)
    a_is_short = size_a <= size_b
    left_out = np.where(a_is_short, more, less)
    # With each word once the other text may be the shorter one.
    word_a, word_b = a.word_size[:, None], b.word_size[None, :]
    words_left_out = np.where(word_a < word_b, more_words, np.where(word_a > word_b, less_words, np.minimum(more_words, less_words)))
    word_short = np.minimum(word_a, word_b)
    inside = (left_out <= short * 2 * max(1 - bound / 90, 0) + 1e-3) | (words_left_out <= word_short * 2 * max(1 - bound / 85.5, 0) + 1e-3)
    return np.where(long < short * 1.5, near, inside & (long <= short * 8))


def _cells(threshold: int, scorer: str, ordered: bool, tokens_apart: bool):
    """Rows ``key, salt, side, form``, sorted, to ``form, ref_form``; with ``ordered`` only pairs whose first text is the lesser.

    ``tokens_apart`` leaves out pairs of unlike lengths that share a word; those are linked without being listed.
    """

    def cell(left: list[str], right: list[str]) -> Iterator[pa.RecordBatch]:
        own, other = Letters(left), Letters(right)
        for i in range(0, len(left), BLOCK):
            for j in range(0, len(right), BLOCK):
                allowed = may_be_alike(own.part(slice(i, i + BLOCK)), other.part(slice(j, j + BLOCK)), threshold, scorer)
                pairs = [(left[i + x], right[j + y]) for x, y in np.argwhere(allowed).tolist()]
                if ordered:
                    pairs = [(p, q) for p, q in pairs if p < q]
                if tokens_apart:
                    pairs = [(p, q) for p, q in pairs if max(len(p), len(q)) < 1.5 * min(len(p), len(q)) or set(p.split()).isdisjoint(q.split())]
                if pairs:
                    yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in pairs], pa.string()), pa.array([q for _, q in pairs], pa.string())], names=["form", "ref_form"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sides = None, ([], [])
        for batch in batches:
            for key, salt, side, form in zip(*(c.to_pylist() for c in batch.columns)):
                if (key, salt) != held:
                    if sides[0] and sides[1]:
                        yield from cell(*sides)
                    held, sides = (key, salt), ([], [])
                sides[side].append(form)
        if sides[0] and sides[1]:
            yield from cell(*sides)

    return run


def pairs_in_cells(left: DataFrame, right: DataFrame, threshold: int, scorer: str, ordered: bool = False, tokens_apart: bool = False) -> DataFrame:
    """``form, ref_form`` of the pairs worth a score, each once, from ``key, salt, form`` of both sides."""
    rows = left.select("key", "salt", F.lit(0).alias("side"), "form").unionByName(right.select("key", "salt", F.lit(1).alias("side"), "form"))
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    arranged = rows.repartition(parts, "key", "salt").sortWithinPartitions("key", "salt")
    return arranged.mapInArrow(_cells(threshold, scorer, ordered, tokens_apart), "form string, ref_form string").distinct()


# --- a batch that one task can settle -------------------------------------------------------------------


def _set_allows(a: set[str], b: set[str], loss: float) -> bool:
    """Whether the words in common are enough of one of two forms of similar length."""
    shared = sum(map(len, a & b)) + len(a & b) - 1
    rest = min(sum(map(len, a - b)) + max(0, len(a - b) - 1), sum(map(len, b - a)) + max(0, len(b - a) - 1))
    return rest == 0 or rest + 1 <= (2 * shared + rest + 1) * loss + 1e-6


class Known:
    """Forms that others are matched against, in order."""

    def __init__(self, forms: list[str], threshold: int, scorer: str):
        self.forms, self.threshold, self.scorer = forms, threshold, scorer
        self.score = fuzzy.SCORERS[scorer]
        self.letters = Letters(forms)
        self.words = [set(f.split()) for f in forms]
        self.loss = max(0.0, 1 - (threshold - 0.5) / 95)
        self.linked = scorer == "wratio" and round(fuzzy.TOKEN_SCORE) >= threshold
        self.by_word: dict[str, list[int]] = {}

    def offer_words(self, i: int) -> None:
        """Let others meet form ``i`` on its words."""
        for w in self.words[i]:
            self.by_word.setdefault(w, []).append(i)

    def by_words(self, form: str, words: set[str]) -> list[int]:
        """The offered forms that the words in common may make alike."""
        if self.scorer != "wratio":
            return []
        out, n = [], len(form)
        for j in {j for w in words for j in self.by_word.get(w, ())}:
            short, long = sorted((n, len(self.forms[j])))
            if (self.linked and long <= 8 * short) if long >= 1.5 * short else _set_allows(words, self.words[j], self.loss):
                out.append(j)
        return out

    def accepted(self, form: str, j: int) -> float | None:
        score = self.score(form, self.forms[j])
        return score if round(score) >= self.threshold else None

    def best(self, forms: list[str], first: bool) -> list[tuple[int, float] | None]:
        """For each form the best of the known ones, the earliest of equals, or with ``first`` the earliest that is accepted."""
        out: list[tuple[int, float] | None] = []
        for start in range(0, len(forms), BLOCK):
            part = forms[start:start + BLOCK]
            own = Letters(part)
            near = np.concatenate([may_be_alike(own, self.letters.part(slice(j, j + BLOCK)), self.threshold, self.scorer) for j in range(0, len(self.forms), BLOCK)], axis=1)
            for form, row in zip(part, near):
                found = None
                for j in sorted({*np.flatnonzero(row).tolist(), *self.by_words(form, set(form.split()))}):
                    score = self.accepted(form, j)
                    if score is not None and (found is None or score > found[1]):
                        found = (j, score)
                        if first:
                            break
                out.append(found)
        return out


def settled(forms: list[str], threshold: int, scorer: str) -> np.ndarray:
    """For each form, in order, the place of the representative it follows, or its own: the sequential loop."""
    known = Known(forms, threshold, scorer)
    leaders: list[int] = []
    out = np.arange(len(forms))
    for start in range(0, len(forms), BLOCK):
        # A block meets the leaders before it at once, and each leader of its own as it comes.
        block = slice(start, start + BLOCK)
        own = known.letters.part(block)
        near: list[set[int]] = [set() for _ in range(len(own.size))]
        for at in range(0, len(leaders), BLOCK):
            some = np.array(leaders[at:at + BLOCK])
            for x, y in np.argwhere(may_be_alike(own, known.letters.part(some), threshold, scorer)).tolist():
                near[x].add(int(some[y]))
        for i, form in enumerate(forms[block], start):
            for j in sorted({*near[i - start], *known.by_words(form, known.words[i])}):
                if known.accepted(form, j) is not None:
                    out[i] = j
                    break
            else:
                leaders.append(i)
                known.offer_words(i)
                later = slice(i - start + 1, None)
                for x in np.flatnonzero(may_be_alike(own.part(later), known.letters.part(slice(i, i + 1)), threshold, scorer)[:, 0]).tolist():
                    near[i - start + 1 + x].add(i)
    return out


def matched(forms: DataFrame, refs: list[tuple], threshold: int, scorer: str, first: bool) -> DataFrame:
    """``pos, ref_pos, score`` of the match of each of ``forms(pos, form)`` among a bounded list of ``(pos, form)``, which goes to every task."""
    refs = sorted(refs)
    places, texts = [p for p, _ in refs], [f for _, f in refs]
    kind = forms.schema["pos"].dataType.simpleString()

    def known_forms() -> Known:
        known = Known(texts, threshold, scorer)
        for i in range(len(texts)):
            known.offer_words(i)
        return known

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = EditTrie(texts, threshold) if scorer == "levenshtein" else None
        known = None
        for batch in batches:
            asked = batch.column(1).to_pylist()
            found: list[tuple[int, float] | None] = [None] * len(asked)
            by_trie = [i for i, form in enumerate(asked) if trie and len(form) <= LONGEST]
            by_letters = [i for i, form in enumerate(asked) if not trie or len(form) > LONGEST]
            if by_trie and texts:
                for i, hit in zip(by_trie, trie.best([asked[i] for i in by_trie], first)):
                    found[i] = hit
            if by_letters and texts:
                known = known or known_forms()
                for i, hit in zip(by_letters, known.best([asked[i] for i in by_letters], first)):
                    found[i] = hit
            hit = [i for i, f in enumerate(found) if f]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(hit, pa.int64())), pa.array([places[found[i][0]] for i in hit], pa.int64()), pa.array([found[i][1] for i in hit], pa.float64())],
                names=["pos", "ref_pos", "score"],
            )

    return forms.select("pos", "form").mapInArrow(run, f"pos {kind}, ref_pos long, score double")
