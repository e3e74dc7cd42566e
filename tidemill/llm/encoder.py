"""Token ids of whole texts with a tokenizer file, computed once per distinct word.

The tokenizer has to be of the word kind: it lower-cases, drops white space and never joins two words separated by white
space, so the ids of a text are the ids of its words one after the other. Words of plain Latin letters, digits and marks are cut
with the tokenizer's own pattern and each piece goes through the library's BPE model; any other word goes through the
whole tokenizer.
"""

from __future__ import annotations

import os
from array import array
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from tidemill.llm.words import rows_of, word_codes

END_ID = 1
TOKENIZER = "word_bpe_49k.json"
#: Distinct words, and pieces of words, remembered by one worker.
MEMORY = 300_000

#: Fixed value: the pattern of the tokenizer file.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
#: A word with any other character goes through the whole tokenizer: lower case and composition are the same everywhere for these.
_OTHER = "[^!-~À-ÖØ-öø-ÿ]"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where the public tokenizer files lie on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself, or the next free code point from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


class Encoder:
    """Encodes Arrow text columns; keeps at most ``MEMORY`` words, and those of the texts at hand."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        specials = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.other = "|".join([_OTHER, *map(regex.escape, specials)])
        self.letters = _byte_letters()
        self.pieces: dict[str, bytes] = {}  # ids as bytes take a fraction of what numbers in tuples take
        self.earlier: dict[str, bytes] = {}
        self.index: dict[str, int] = {}
        self.pool = np.empty(1 << 16, np.uint32)
        self.used = 0
        self.starts, self.counts, self.seen = (np.zeros(1 << 14, np.int64) for _ in range(3))

    def _forget(self) -> None:
        """Keep the words that came most often, half of ``MEMORY`` at most and none that came in one slice only."""
        seen = self.seen[:len(self.index)]
        often = np.argsort(-seen, kind="stable")[:MEMORY // 2]
        keep = np.sort(often[seen[often] > 1])
        words = list(self.index)
        self.index = {words[i]: n for n, i in enumerate(keep.tolist())}
        counts = self.counts[keep]
        self.pool = self.pool[rows_of(self.starts[keep], counts)]
        self.used = len(self.pool)
        self.starts, self.counts, self.seen = np.cumsum(counts) - counts, counts, seen[keep] // 2

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            ids = self.earlier.get(piece)
            if ids is None:
                shown = piece if piece.isascii() else "".join([self.letters[b] for b in piece.encode()])
                ids = _packed([t.id for t in self.model.tokenize(shown)])
            if len(self.pieces) >= MEMORY // 2:
                self.pieces, self.earlier = {}, self.pieces
            self.pieces[piece] = ids
        return ids

    def _plain(self, word: str) -> bytes:
        """The ids of a lower-cased word of plain letters, digits and marks."""
        if word.isalpha():
            return self._piece(word)
        if word[:-1].isalpha() and not word[-1].isalnum():
            return self._piece(word[:-1]) + self._piece(word[-1])
        return b"".join(map(self._piece, PIECES.findall(word)))

    def _add(self, words: list[str]) -> None:
        """Remember the ids of new words (strings without ASCII white space)."""
        column = pa.array(words, pa.string())
        other = pc.match_substring_regex(column, self.other).to_numpy(zero_copy_only=False)
        lowered = pc.utf8_lower(column).to_numpy(zero_copy_only=False)
        packed = [_packed(self.whole.encode(w, add_special_tokens=False).ids) if o else self._plain(x) for w, x, o in zip(words, lowered, other)]
        counts = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        need, have = self.used + int(counts.sum()), len(self.index)
        if need > len(self.pool):
            self.pool = np.resize(self.pool, max(need, 2 * len(self.pool)))
        if have + len(words) > len(self.starts):
            size = max(have + len(words), 2 * len(self.starts))
            self.starts, self.counts, self.seen = (np.resize(x, size) for x in (self.starts, self.counts, self.seen))
        self.pool[self.used:need] = np.frombuffer(b"".join(packed), np.uint32)
        new = slice(have, have + len(words))
        self.counts[new] = counts
        self.starts[new] = self.used + np.cumsum(counts) - counts
        self.seen[new] = 0
        self.index.update(zip(words, range(have, have + len(words))))
        self.used = need

    def _places(self, words: list[str]) -> tuple[np.ndarray, list[int]]:
        """Where the words are remembered (-1: not), and the numbers of those that are not, but for the empty one."""
        places = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        return places, [i for i in np.flatnonzero(places < 0).tolist() if words[i]]

    def encode(self, texts: pa.Array, end_id: int | None = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, offsets)``: text ``i`` has ``ids[offsets[i]:offsets[i + 1]]``, the last being ``end_id`` unless that is None."""
        codes, bounds, words = word_codes(texts)
        distinct = words.to_numpy(zero_copy_only=False).tolist()
        places, missing = self._places(distinct)
        if len(self.index) + len(missing) > MEMORY and self.index:
            self._forget()
            places, missing = self._places(distinct)
        if missing:
            places[missing] = np.arange(len(self.index), len(self.index) + len(missing))
            self._add([distinct[i] for i in missing])
        self.seen[places[places >= 0]] += 1
        at = places[codes]
        counts = self.counts[at]
        token_ends = np.concatenate([[0], np.cumsum(counts)])
        ids = self.pool[rows_of(self.starts[at], counts)]
        offsets = token_ends[bounds]
        if end_id is None:
            return ids, offsets
        ids = np.insert(ids, offsets[1:], np.uint32(end_id))
        return ids, offsets + np.arange(len(offsets))


@lru_cache(maxsize=1)
def shared_encoder(path: str) -> Encoder:
    """The encoder of this worker process; tasks that run in it one after the other share what it remembers."""
    return Encoder(path)
