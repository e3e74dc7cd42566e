"""Fuzzy name scores from 0 to 100 and the keys that find every pair worth scoring.

``wratio`` is the published weighted ratio: the indel ratio for names of similar length, and scaled
token and best-window ratios beside it.

Why a shared key is enough. Pad a form with one space at each end. A ratio above 80 leaves fewer than
T/5 insertions and deletions for total length T, hence a common run of at least three characters: the
padded forms share a trigram. The same holds for the sorted tokens, and a best window scaled by 0.9 needs a
ratio above 89. So above a threshold of 80 every accepted pair shares a trigram of the form or of its sorted
tokens, except where one form is a token of at most two characters: then that lies inside the other as it is.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, functions as F

from tidemill.functions.strings import let, null_if_empty, strip
from tidemill.functions.text import clean_name

#: Below this threshold a shared key no longer follows from an accepted score.
MIN_THRESHOLD = 81
#: One shared token is worth this much when the lengths differ by a factor of 1.5 to 8.
TOKEN_SCORE = 100 * 0.95 * 0.9


# --- column expressions ---------------------------------------------------------------------------


def form(name: Column, clean: bool = True) -> Column:
    """What the scorers compare: Latin-1 letters outside ASCII deleted, punctuation to spaces, lower case."""
    text = F.regexp_replace(clean_name(name) if clean else name, "[\u0080-ÿ]", "")
    return strip(F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}_]", " ")))


def tokens(form: Column) -> Column:
    return F.filter(F.array_distinct(F.split(form, r"\s+")), lambda t: t != "")


def _trigrams(text: Column) -> Column:
    padded = F.concat(F.lit(" "), text, F.lit(" "))
    return let(padded, lambda p: F.transform(F.sequence(F.lit(1), F.length(p) - 2), lambda i: F.substring(p, i, F.lit(3))))


def key_lists(form: Column) -> Column:
    """The distinct trigrams of a form, of its sorted tokens and of its sorted, distinct tokens, as three lists."""
    words = F.array_sort(F.split(form, r"\s+"))
    texts = (form, F.array_join(words, " "), F.array_join(F.array_distinct(words), " "))
    return F.array(*[F.array_distinct(_trigrams(t)) for t in texts])


def keys(form: Column) -> Column:
    """The trigrams of a form and of its sorted tokens; null for an empty form."""
    return F.when(form != "", F.array_distinct(F.flatten(key_lists(form))))


def short_keys(form: Column) -> Column:
    """A form made of one token of at most two characters, repeated or not; null for other forms."""
    words = F.array_distinct(F.split(form, r"\s+"))
    return F.when((form != "") & (F.size(words) == 1) & (F.length(F.get(words, F.lit(0))) <= 2), words)


def inner_keys(form: Column) -> Column:
    """All one- and two-character runs of a form: what a ``short_keys`` form can lie inside."""
    runs = F.transform(
        F.sequence(F.lit(1), F.length(form)),
        lambda i: F.array(F.substring(form, i, F.lit(1)), F.substring(form, i, F.lit(2))),
    )
    return F.when(form != "", F.array_distinct(F.flatten(runs)))


def levenshtein_score(a: Column, b: Column) -> Column:
    """Whole percent of the longer form that edits leave unchanged."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when((a != "") & (b != ""), F.floor((longest - F.levenshtein(a, b)) * 100 / longest)).otherwise(0).cast("double")


# --- scorers used inside Arrow batches -----------------------------------------------------------


@lru_cache(8192)
def _masks(text: str) -> dict[str, int]:
    """For each character the positions it takes, one bit each."""
    masks: dict[str, int] = {}
    for i, ch in enumerate(text):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    return masks


def _lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, one bit per character of ``a``."""
    masks = _masks(a)
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & masks.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    if not total:
        return 100.0
    return (1 - (total - 2 * _lcs(a, b)) / total) * 100


def _window_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter text against the windows of the longer one, cut-off ones at the ends included."""
    if len(a) > len(b):
        a, b = b, a
    m, n = len(a), len(b)
    if not m:
        return 0.0
    if a in b:
        return 100.0
    # Left to right: cut-off windows at the start, whole windows, cut-off windows at the end.
    windows = {b[max(0, end - m) : end] for end in range(1, n + 1)} | {b[start:] for start in range(n - m + 1, n)}
    letters = set(a)
    best = 0.0
    for w in windows:
        if 200 * min(m, len(w), sum(ch in letters for ch in w)) / (m + len(w)) > best:
            best = max(best, ratio(a, w))
    return max(best, _window_ratio_equal(b, a)) if m == n else best


def _window_ratio_equal(a: str, b: str) -> float:
    cuts = {b[:i] for i in range(1, len(b) + 1)} | {b[i:] for i in range(len(b))}
    return max(ratio(a, w) for w in cuts)


def _share(distance: int, total: int) -> float:
    return 100 - 100 * distance / total if total else 100.0


def _token_ratio(a: str, b: str) -> float:
    """The better of sorted-token and token-set ratio."""
    words_a, words_b = sorted(a.split()), sorted(b.split())
    best = ratio(" ".join(words_a), " ".join(words_b))
    set_a, set_b = set(words_a), set(words_b)
    common = set_a & set_b
    if common and (common == set_a or common == set_b):
        return 100.0
    only_a, only_b = " ".join(sorted(set_a - common)), " ".join(sorted(set_b - common))
    shared = len(" ".join(sorted(common)))
    gap = 1 if shared else 0
    full_a, full_b = shared + gap + len(only_a), shared + gap + len(only_b)
    distance = len(only_a) + len(only_b) - 2 * _lcs(only_a, only_b)
    best = max(best, _share(distance, full_a + full_b))
    if shared:
        best = max(best, _share(gap + len(only_a), shared + full_a), _share(gap + len(only_b), shared + full_b))
    return best


def _window_token_ratio(a: str, b: str) -> float:
    words_a, words_b = sorted(a.split()), sorted(b.split())
    set_a, set_b = set(words_a), set(words_b)
    if set_a & set_b:
        return 100.0
    best = _window_ratio(" ".join(words_a), " ".join(words_b))
    if len(set_a) < len(words_a) or len(set_b) < len(words_b):
        best = max(best, _window_ratio(" ".join(sorted(set_a)), " ".join(sorted(set_b))))
    return best


def wratio(a: str, b: str) -> float:
    """The weighted ratio of two forms, not rounded; 0 when either is empty."""
    if not a or not b:
        return 0.0
    if a == b:
        return 100.0
    spread = max(len(a), len(b)) / min(len(a), len(b))
    best = ratio(a, b)
    if spread < 1.5:
        return max(best, _token_ratio(a, b) * 0.95)
    scale = 0.9 if spread <= 8 else 0.6
    return max(best, _window_ratio(a, b) * scale, _window_token_ratio(a, b) * 0.95 * scale)


def plain_ratio(a: str, b: str) -> float:
    return ratio(a, b) if a and b else 0.0


def _edits(a: str, b: str) -> int:
    """Levenshtein distance, one bit per character of ``a``."""
    masks, full, last = _masks(a), (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, distance = full, 0, len(a)
    for ch in b:
        hit = masks.get(ch, 0)
        same = (((hit & up) + up) ^ up) | hit | down
        right, left = down | ~(same | up), up & same
        distance += bool(right & last) - bool(left & last)
        right, left = (right << 1) | 1, left << 1
        up, down = (left | ~(same | right)) & full, right & same & full
    return distance


def levenshtein(a: str, b: str) -> float:
    """The same as ``levenshtein_score``."""
    if not a or not b:
        return 0.0
    longest = max(len(a), len(b))
    return float((longest - _edits(a, b)) * 100 // longest)


SCORERS = {"wratio": wratio, "ratio": plain_ratio, "levenshtein": levenshtein}


def _short(text: str) -> str:
    words = set(text.split())
    return words.pop() if len(words) == 1 and len(min(words)) <= 2 else ""


def _key_set(text: str) -> set[str]:
    words = sorted(text.split())
    padded = [f" {text} ", f" {' '.join(words)} ", f" {' '.join(sorted(set(words)))} "]
    return {p[i : i + 3] for p in padded for i in range(len(p) - 2)}
