"""Plain Python versions of what the operators compute."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF_DIR = "/root/testdata/sf0.001"


def lower(text: str) -> str:
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text)


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def shingles(text: str | None, width: int) -> set[tuple[str, ...]]:
    w = [lower(x) for x in words(text)]
    if not w:
        return set()
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))}


def groups(names: list, links: list[tuple[int, int]]) -> list:
    """The least name of each item's component; items and links by position."""
    at = list(range(len(names)))

    def find(i: int) -> int:
        while at[i] != i:
            at[i] = at[at[i]]
            i = at[i]
        return i

    for a, b in links:
        at[find(a)] = find(b)
    least: dict[int, int] = {}
    for i, name in enumerate(names):
        if name is not None:
            least[find(i)] = min(least.get(find(i), name), name)
    return [least.get(find(i)) for i in range(len(names))]
