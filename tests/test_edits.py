"""References within some edits, found by a trie, against scoring every pair."""

import random

import pytest

from tidemill.functions import fuzzy
from tidemill.operators import resolve
from tidemill.operators.edits import LONGEST, EditTrie
from tidemill.sources.seeds import load_seeds


def changed(rng, text, letters):
    text = list(text)
    for _ in range(rng.randint(0, 4)):
        at = rng.randrange(len(text) + 1)
        text[at : at + rng.randint(0, 1)] = rng.choice(["", rng.choice(letters), rng.choice(letters) + "z"])
    return "".join(text)[:LONGEST]


def plain(query, refs, threshold, first):
    accepted = [(j, s) for j, s in ((j, fuzzy.levenshtein(query, r)) for j, r in enumerate(refs)) if s >= threshold]
    return (accepted[0] if first else max(accepted, key=lambda x: (x[1], -x[0]))) if accepted else None


@pytest.mark.parametrize("letters, low, high", [("ab", 1, 20), ("abc é京 ", 8, 40), ("0123456789", 7, 9), ("ab", 30, 63), ("x", 1, 63)])
@pytest.mark.parametrize("threshold", [81, 85, 100])
def test_equal_scores_of_all_pairs(letters, low, high, threshold):
    rng = random.Random(3)
    refs = ["".join(rng.choice(letters) for _ in range(rng.randint(low, high))) for _ in range(120)]
    queries = [q for q in (changed(rng, r, letters) for r in refs * 2) if q]
    for first in (False, True):
        assert EditTrie(refs, threshold).best(queries, first) == [plain(q, refs, threshold, first) for q in queries]


def test_nothing_to_find():
    assert EditTrie([], 85).best(["a"], False) == [None]
    assert EditTrie(["", "a"], 85).best(["b", "", "a"], True) == [None, None, (1, 100.0)]


def test_work_follows_the_near_references(monkeypatch):
    """Ten times the references, as many of them near: the trie takes no ten times the steps."""
    rng = random.Random(1)
    steps = []
    near = EditTrie._near

    def walk(self, queries, edits):
        counts = self.count
        self.count = type("Counted", (), {"__getitem__": lambda _, at: (steps.append(len(at)), counts[at])[1]})()
        yield from near(self, queries, edits)
        self.count = counts

    monkeypatch.setattr(EditTrie, "_near", walk)
    taken = []
    for digits, n in ((5, 1_000), (6, 10_000)):
        names = [f"customer {i:09d}" for i in rng.sample(range(10**digits), n + 50)]
        steps.clear()
        EditTrie(names[50:], 85).best(names[:50], True)
        taken.append(sum(steps))
    assert taken[1] < 4 * taken[0] and taken[1] < 50 * n


@pytest.mark.parametrize("rows", [10_000, 3])
def test_long_and_short_names(spark, monkeypatch, rows):
    monkeypatch.setattr(resolve, "BROADCAST_ROWS", rows)
    seeds = ["acme robotics", "x" * 40 + "y" * 40, "acme robotic", "zeta", "open mind"]
    names = ["acme robotics", "acme robotik", "x" * 40 + "y" * 38, "x" * 66, "zetta", "opn mind", "", "none of them"]
    df = spark.createDataFrame(list(enumerate(names)), "pos long, name string")
    got = {r.name: (r.canonical_name, r.match_score) for r in resolve.canonicalize(df, load_seeds(spark, seeds=seeds), scorer="levenshtein").collect()}
    for name in names:
        best = plain(name, seeds, 85, False)
        assert got[name] == ((seeds[best[0]], int(best[1])) if best else (name, 0))
