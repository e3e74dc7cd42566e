"""Document fingerprints by consistent weighted sampling (operator 9).

The terms of a text are its words, lower-cased in A-Z, each weighing as often as it occurs. Sample ``k`` of a text looks, for every
term of weight ``w``, at

    t = floor(ln(w) / r + b),    ln(a) = ln(c) - r * (t - b + 1)

with ``r`` and ``c`` from Gamma(2, 1) and ``b`` uniform, all three drawn from a hash of the term and ``k`` alone, and keeps the term (and its
``t``) of least ``a``. Two texts keep the same with probability sum(min(w, w')) / sum(max(w, w')), the generalised Jaccard likeness.
The fingerprint holds 16 bits of a hash of each kept pair, as hexadecimal text; the likeness of two fingerprints is the share of equal
samples.

Defined cases: a text without words (null, empty, white space) has the fingerprint of all ``f``; two of those are alike, likeness 1. Repeated
rows have equal fingerprints. The document after another is the next one in descending ``doc_id`` (null last), copies of one id in descending text
order; after the last comes the first, so a single document follows itself. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidemill.llm.words import hashes, mix, slices, text_column, word_codes

SAMPLES = 64
#: Text bytes sketched at once; tables of ``SAMPLES`` numbers per distinct weighted term are held for them.
SKETCH_BYTES = 6 << 20
_EMPTY = 0xFFFF


def _uniforms(keys: np.ndarray, column: int, samples: int, bits: int = 21) -> list[np.ndarray]:
    """Three numbers in (0, 1) that depend on the key, the column and the sample."""
    salts = mix(np.arange(samples, dtype=np.uint64) + np.uint64(column * 4096 + 1))
    drawn = mix(keys[:, None] ^ salts[None, :])
    mask, scale = np.uint64((1 << bits) - 1), np.float32(0.5**bits)
    return [(((drawn >> np.uint64(shift)) & mask).astype(np.float32) + np.float32(0.5)) * scale for shift in (1, 1 + bits, 1 + 2 * bits)]


def _order_bits(x: np.ndarray) -> np.ndarray:
    """32-bit floats as unsigned integers in the same order."""
    raw = x.astype(np.float32).view(np.uint32)
    return np.where(raw >> 31, ~raw, raw | np.uint32(1 << 31))


def _ranks(terms: np.ndarray, weights: np.ndarray, samples: int) -> np.ndarray:
    """For every weighted term and sample: ``a`` as order bits above the hash of the term and its ``t``."""
    u1, u2, b = _uniforms(terms, 0, samples)
    u3, u4, _ = _uniforms(terms, 1, samples)
    r = -np.log(u1 * u2)  # the sum of two exponential numbers is Gamma(2, 1)
    ln_c = np.log(-np.log(u3 * u4))
    single = weights == 1
    t = np.zeros(r.shape, np.float32)
    if not single.all():
        more = ~single
        t[more] = np.floor(np.log(weights[more].astype(np.float32))[:, None] / r[more] + b[more])
    ln_a = ln_c - r * (t - b + 1)
    kept = mix(terms)[:, None] + t.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (_order_bits(ln_a).astype(np.uint64) << np.uint64(32)) | (kept >> np.uint64(32))


def sketch(texts: pa.Array, samples: int = SAMPLES) -> np.ndarray:
    """One row of ``samples`` 16-bit numbers per text."""
    out = np.full((len(texts), samples), _EMPTY, np.uint16)
    codes, bounds, words = word_codes(pc.ascii_lower(texts))
    if not len(codes):
        return out
    doc = np.repeat(np.arange(len(texts)), np.diff(bounds))
    pairs, weights = np.unique(doc * len(words) + codes, return_counts=True)
    doc, word = pairs // len(words), pairs % len(words)
    most = int(weights.max()) + 1
    weighted, place = np.unique(word * most + weights, return_inverse=True)
    terms = hashes(words.to_numpy(zero_copy_only=False).tolist())
    table = np.empty((len(weighted), samples), np.uint64)
    for i in range(0, len(weighted), 4096):  # so that the tables of numbers drawn stay in the cache
        some = weighted[i:i + 4096]
        table[i:i + 4096] = _ranks(terms[some // most], some % most, samples)
    present, starts = np.unique(doc, return_index=True)
    ends = np.append(starts[1:], len(doc))
    for row, a, z in zip(present.tolist(), starts.tolist(), ends.tolist()):
        least = table[place[a:min(z, a + 4096)]].min(axis=0)
        for more in range(a + 4096, z, 4096):
            least = np.minimum(least, table[place[more:min(z, more + 4096)]].min(axis=0))
        out[row] = (least & np.uint64(0xFFFF)).astype(np.uint16)
    return out


def _hex(rows: np.ndarray) -> list[str]:
    text = rows.astype(">u2").tobytes().hex()
    width = 4 * rows.shape[1]
    return [text[i:i + width] for i in range(0, len(text), width)]


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """``docs(doc_id, text)`` with ``fingerprint``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=SKETCH_BYTES):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(_hex(sketch(text_column(part), samples)))], names=["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fingerprint string")


def likeness(a: str, b: str) -> float:
    """The share of equal samples of two fingerprints."""
    return float(np.mean(np.frombuffer(bytes.fromhex(a), ">u2") == np.frombuffer(bytes.fromhex(b), ">u2")))


def with_following(docs: DataFrame, parts: int) -> DataFrame:
    """Documents dealt into ``parts`` ranges of ids and sorted, each range followed by a copy of the document after it.

    Columns ``part, doc_id, text, extra``; rows of one part are together and in descending order, the copy (``extra``) last.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    bounds = sorted(set(rows.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.2 / parts)), reverse=True) if parts > 1 else []
    # Part 0 has the largest ids; null ids come last.
    part = F.when(F.col("doc_id").isNull(), len(bounds)).otherwise(F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: F.col("doc_id") <= b)) if bounds else F.lit(0))
    rows = rows.withColumn("part", part.cast("int")).withColumn("extra", F.lit(False))
    order = F.struct(F.col("doc_id").isNotNull(), "doc_id", "text")
    firsts = {r.part: r.first for r in rows.groupBy("part").agg(F.max(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")).alias("first")).collect()}  # one id a part
    if not firsts:
        return rows.select("part", "doc_id", "text", "extra")
    present = sorted(firsts)
    heads = [(firsts[after].doc_id, p) for p, after in zip(present, present[1:] + present[:1])]
    head_rows = docs.sparkSession.createDataFrame(heads, "head long, part int")
    copies = rows.drop("part").join(F.broadcast(head_rows), F.col("doc_id").eqNullSafe(F.col("head")))  # one id a part
    copies = copies.groupBy("part").agg(F.max(order).alias("o")).select("o.doc_id", "o.text", "part", F.lit(True).alias("extra"))
    both = rows.select("part", "doc_id", "text", "extra").unionByName(copies.select("part", "doc_id", "text", "extra"))
    return both.repartition(parts, "part").sortWithinPartitions("part", "extra", F.desc_nulls_last("doc_id"), F.desc("text"))


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(samples: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None  # the last row so far, whose following document is not known yet
        for batch in batches:
            for piece in slices(batch, limit=SKETCH_BYTES):
                rows = piece if held is None else pa.Table.from_batches([held, piece]).combine_chunks().to_batches()[0]
                if rows.num_rows > 1:
                    yield from compared(rows)
                held = rows.slice(rows.num_rows - 1)

    def compared(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        parts, ids, texts, extra = (rows.column(i).to_pylist() for i in range(4))
        own = [i for i in range(len(ids) - 1) if not extra[i]]
        if not own:
            return
        edited = []
        for i in own:
            cut_off = len(texts[i]) // 3
            edited.append(texts[i][:len(texts[i]) - cut_off] + texts[i + 1][:cut_off])
        both = sketch(pa.concat_arrays([rows.column(2), pa.array(edited, pa.string())]), samples)  # together, as they share most terms
        plain, changed = both[:len(ids)], both[len(ids):]
        at = np.array(own)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([ids[i] for i in own], pa.int64()), pa.array([len(texts[i]) for i in own], pa.int64()),
                pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited]), pa.array(_hex(plain[at])), pa.array(_hex(changed)),
                pa.array((plain[at] == changed).mean(axis=1)), pa.array((plain[at] == plain[at + 1]).mean(axis=1)),
            ],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    return run


def compare_edited(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Every document beside its edited text (its last third replaced by the start of the following document)."""
    parts = 3 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return with_following(docs, parts).mapInArrow(_compare(samples), SCHEMA)
