"""Connected components of a table of links, by contraction.

In each round every node goes over to the neighbour (or stays itself) that comes first in a random order of the nodes, links are redrawn
between the nodes gone over to, and those inside one node vanish. A constant share of the nodes disappears per round, so chains are no worse than
stars. Each round is an aggregate and two joins. Nothing is gathered on the driver, and one task gets links only when at most ``SETTLE_LINKS`` are left:
it settles them at once, which spares the many small rounds at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemill.session import cut

#: As many links, and no more, are settled by one task.
SETTLE_LINKS = 20_000


class Forest:
    """Groups of numbers that are joined two by two; a group is named by its least number."""

    def __init__(self):
        self.above: dict[int, int] = {}

    def find(self, x: int) -> int:
        while (up := self.above.get(x, x)) != x:
            self.above[x] = x = self.above.get(up, up)
        return x

    def join(self, x: int, y: int) -> bool:
        """True if they were apart."""
        x, y = self.find(x), self.find(y)
        self.above[max(x, y)] = min(x, y)
        return x != y


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All links that are left, in one task, to every node's least node."""
    forest, nodes = Forest(), set()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            forest.join(a, b)
            nodes.update((a, b))
    at = sorted(nodes)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array([forest.find(x) for x in at], pa.int64())], names=["node", "to"])


def components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` of longs: ``node, component`` for every node that has a link to another; a component is named by its least node."""
    links = cut(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    rounds: list[DataFrame] = []
    while left := links.limit(SETTLE_LINKS + 1).count():
        if left <= SETTLE_LINKS:
            rounds.append(cut(links.coalesce(1).mapInArrow(_settle, "node long, to long")))
            break
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        def place(c: str):
            return F.struct(F.xxhash64(c, F.lit(len(rounds))).alias("h"), F.col(c).alias("x"))

        first = both.groupBy("a").agg(F.min(place("b")).alias("m"))
        moves = cut(first.select(F.col("a").alias("node"), F.least("m", place("a")).alias("m")).select("node", F.col("m.x").alias("to")))
        rounds.append(moves)
        moved = links.join(moves.toDF("a", "ta"), "a").join(moves.toDF("b", "tb"), "b").filter("ta <> tb")
        links = cut(moved.select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct())
    if not rounds:
        return links.select(F.col("a").alias("node"), F.col("a").alias("component"))
    at = rounds[0].select("node", F.col("to").alias("root"))
    if len(rounds) == 1 and left:  # settled at once, by least nodes
        return at.toDF("node", "component")
    for moves in rounds[1:]:
        step = moves.select(F.col("node").alias("root"), "to")
        at = at.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    at = cut(at)
    names = at.groupBy("root").agg(F.min("node").alias("component"))
    return at.join(names, "root").select("node", "component")
