"""Texts within some edits of others, by walking a trie: what many references begin with is compared once.

A state is a query at a node of the trie with one word of bits for each number of edits: bit ``i`` says that the first ``i`` letters of the query become
the node's text with at most so many. A state without bits is dropped with all that lies below its node, so the work follows the references that are near,
not all of them. All states of a block of queries take a step together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Queries up to this many letters fit a word; others are compared by their counts of letters.
LONGEST = 63
#: States that take a step together, and cells of the table that says where a letter stands in a query.
STATES, MASK_CELLS = 1 << 18, 1 << 21
_ONE = np.uint64(1)


def _points(texts: list[str], width: int) -> np.ndarray:
    """The code points of the texts plus one, a row for each, filled up with zeros."""
    out = np.zeros((len(texts), width), np.uint32)
    lengths = np.array([len(t) for t in texts], np.int64)
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32) + np.uint32(1)
    starts = np.cumsum(lengths) - lengths
    out[np.repeat(np.arange(len(texts)), lengths), np.arange(len(flat)) - np.repeat(starts, lengths)] = flat
    return out


class EditTrie:
    """References in order, asked for those whose share of unedited letters of the longer text is at least ``threshold`` whole percent."""

    def __init__(self, refs: list[str], threshold: int):
        self.threshold = threshold
        self.sizes = np.array([len(r) for r in refs], np.int64)
        earliest: dict[str, int] = {}
        most = LONGEST * 100 // threshold + 1  # a longer one needs too many edits
        for i, ref in enumerate(refs):
            if 0 < len(ref) <= most:
                earliest.setdefault(ref, i)
        texts = sorted(earliest)
        self.lengths = np.array(sorted({len(t) for t in texts}), np.int64)
        width = int(self.lengths[-1]) if texts else 0
        points = _points(texts, width)
        self.alphabet = np.unique(points[points > 0])
        sizes = np.array([len(t) for t in texts], np.int64)
        place = np.array([earliest[t] for t in texts], np.int64)
        letters, ends, firsts, counts = [np.zeros(1, np.int32)], [np.full(1, -1)], [], []
        own, total = np.zeros(len(texts), np.int64), 1  # the node that each text has reached
        rows, level = np.arange(len(texts)), 1
        for d in range(width):
            rows = rows[sizes[rows] > d]
            letter, parent = points[rows, d], own[rows]
            new = np.ones(len(rows), bool)
            new[1:] = (letter[1:] != letter[:-1]) | (parent[1:] != parent[:-1])
            node = total + np.cumsum(new) - 1
            made = int(new.sum())
            children = np.bincount(parent[new] - (total - level), minlength=level)
            counts.append(children)
            firsts.append(total + np.cumsum(children) - children)
            own[rows] = node
            letters.append(np.searchsorted(self.alphabet, letter[new]).astype(np.int32))
            end = np.full(made, -1)
            last = sizes[rows] == d + 1
            end[node[last] - total] = place[rows[last]]
            ends.append(end)
            total, level = total + made, made
        counts.append(np.zeros(level, np.int64))
        firsts.append(np.zeros(level, np.int64))
        self.letter, self.end, self.first, self.count = (np.concatenate(x) for x in (letters, ends, firsts, counts))

    def _allowed(self, size: int) -> tuple[int, np.ndarray]:
        """The most edits a query of this length may have, and the best score that each number of edits could give."""
        longest = np.maximum(self.lengths, size)
        most = longest * (100 - self.threshold) // 100
        longest, most = longest[np.abs(self.lengths - size) <= most], most[np.abs(self.lengths - size) <= most]
        k = int(most.max()) if len(most) else -1
        return k, np.array([(int(longest.max()) - d) * 100 // int(longest.max()) for d in range(k + 1)])

    def _near(self, queries: list[str], edits: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``query, reference, edits`` of all pairs of texts of one length and references with at most ``edits``."""
        size, letters = len(queries[0]), len(self.alphabet)
        points = _points(queries, size)
        codes = np.minimum(np.searchsorted(self.alphabet, points), letters - 1)
        known = self.alphabet[codes] == points
        masks = np.zeros((len(queries), letters), np.uint64)
        for i in range(size):
            at = np.flatnonzero(known[:, i])
            masks[at, codes[at, i]] |= _ONE << np.uint64(i)
        full = np.uint64((1 << (size + 1)) - 1)
        start = [np.full(len(queries), min((1 << (j + 1)) - 1, int(full)), np.uint64) for j in range(edits + 1)]
        blocks = [(np.arange(len(queries)), np.zeros(len(queries), np.int64), start)]
        while blocks:
            query, node, rows = blocks.pop()
            if len(query) > STATES:
                for at in range(0, len(query), STATES):
                    blocks.append((query[at:at + STATES], node[at:at + STATES], [r[at:at + STATES] for r in rows]))
                continue
            children = self.count[node]
            origin = np.repeat(np.arange(len(query)), children)
            if not len(origin):
                continue
            before = np.cumsum(children) - children
            node = self.first[node][origin] + np.arange(len(origin)) - before[origin]
            query = query[origin]
            mask = masks[query, self.letter[node]]
            old = [r[origin] for r in rows]
            rows = [((old[0] & mask) << _ONE) & full]
            for j in range(1, edits + 1):
                rows.append((((old[j] & mask) | old[j - 1] | rows[j - 1]) << _ONE | old[j - 1]) & full)
            alive = np.flatnonzero(rows[-1])
            query, node, rows = query[alive], node[alive], [r[alive] for r in rows]
            done = np.flatnonzero((self.end[node] >= 0) & (rows[-1] >> np.uint64(size) != 0)) if len(alive) else alive
            if len(done):
                yield query[done], self.end[node[done]], edits + 1 - sum((r[done] >> np.uint64(size)).astype(np.int64) for r in rows)
            if len(alive):
                blocks.append((query, node, rows))

    def best(self, queries: list[str], first: bool) -> list[tuple[int, float] | None]:
        """For each query of at most ``LONGEST`` letters the best reference, the earliest of equals, or with ``first`` the earliest that is accepted."""
        out: list[tuple[int, float] | None] = [None] * len(queries)
        by_size: dict[int, list[int]] = {}
        for i, q in enumerate(queries):
            by_size.setdefault(len(q), []).append(i)
        part = max(1, MASK_CELLS // max(1, len(self.alphabet)))
        for size, places in by_size.items():
            most, could_be = self._allowed(size) if size else (-1, None)
            # Few edits first; more only where they could still give a score as good.
            for edits in range(max(most, 0) if first else 0, most + 1):
                left = [i for i in places if first or out[i] is None or out[i][1] <= could_be[edits]]
                for at in range(0, len(left), part):
                    self._take(queries, left[at:at + part], size, edits, first, out)
        return out

    def _take(self, queries: list[str], places: list[int], size: int, edits: int, first: bool, out: list) -> None:
        found = list(self._near([queries[i] for i in places], edits))
        if not found:
            return
        query, ref, away = (np.concatenate(x) for x in zip(*found))
        longest = np.maximum(size, self.sizes[ref])
        score = (longest - away) * 100 // longest
        kept = score >= self.threshold
        query, ref, score = query[kept], ref[kept], score[kept]
        order = np.lexsort((ref, query) if first else (ref, -score, query))
        query, ref, score = query[order], ref[order], score[order]
        heads = np.flatnonzero(np.diff(query, prepend=-1))
        for q, r, s in zip(query[heads].tolist(), ref[heads].tolist(), score[heads].tolist()):
            out[places[q]] = (r, float(s))
