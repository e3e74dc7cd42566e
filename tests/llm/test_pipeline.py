"""The registered queries of the subpackage, and the pipeline stage by stage against plain Python."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__ as entry_point
import corpus_pipeline
from tests.llm.helpers import SF_DIR, groups, shingles, words
from tests.llm.test_mixing_and_fingerprints import _targets
from tidemill.llm import oracles, queries, severity
from tidemill.llm.encoder import Encoder, tokenizer_path
from tidemill.session import cut
from workload import check


@pytest.fixture(scope="module")
def database():
    return check.database(SF_DIR)


def test_registered():
    names = set(entry_point.queries())
    assert {n.split("_")[0] for n in queries.queries()} == {f"op{i}" for i in range(1, 11)}
    assert set(queries.queries()) <= names and "pipeline" in names and set(oracles.oracles()) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(oracles.oracles()))
def test_equals_sql(spark, database, name):
    assert check.differences(spark, database, queries.queries()[name], oracles.oracles()[name], SF_DIR) == []


def test_columns(spark):
    columns = {name: f(spark, SF_DIR).columns for name, f in queries.queries().items() if name.split("_")[0] in ("op1", "op3", "op6", "op9")}
    assert columns["op1_main_text"] == ["page_id", "url", "text", "n_chars"]
    assert columns["op9_fingerprints"] == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    names, tables = [n for n, _ in corpus_pipeline.STAGES], [docs]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(cut(stage(spark, tables[-1], SF_DIR)))
    assert len(names) == 5 and all(t.columns == docs.columns for t in tables[:-1])
    rows = [t.collect() for t in tables]
    raw, clean, single, private, mixed, packed = rows

    model = severity.fit(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    toxic = {r.doc_id for r in severity.score(docs, model).collect() if r.toxic}
    assert sorted(clean) == sorted(r for r in raw if r.doc_id not in toxic)

    sets = [shingles(r.text, 5) for r in clean]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    least = groups([r.doc_id for r in clean], links)
    assert sorted(single) == sorted(r for r, n in zip(clean, least) if r.doc_id == n)

    before = {r.doc_id: r for r in single}
    assert {r.doc_id for r in private} == set(before) and all(r.n_chars == len(r.text) for r in private)
    changed = [r for r in private if r.text != before[r.doc_id].text]
    assert changed and all("@" in before[r.doc_id].text or any(c.isdigit() for c in before[r.doc_id].text) for r in changed)

    sizes, largest, taken = defaultdict(int), Counter(), Counter()
    for r in private:
        sizes[r.source] += len(words(r.text))
        largest[r.source] = max(largest[r.source], len(words(r.text)))
    for r in mixed:
        taken[r.source] += len(words(r.text))
    for source, target in _targets(sizes).items():
        assert abs(taken[source] - target) <= max(0.05 * target, largest[source] / 2)  # documents are taken whole
    assert max(Counter(r.doc_id for r in mixed).values()) <= 2 and set(mixed) <= set(private)

    encoder = Encoder(tokenizer_path())
    want = Counter()
    for r in mixed:
        ids = [*encoder.whole.encode(r.text, add_special_tokens=False).ids, 1]
        for start in range(0, len(ids), 4096):
            piece = ids[start:start + 4096]
            want[r.doc_id, start // 4096, start, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == want
    loads = Counter()
    for r in packed:
        loads[r.sequence_id] += r.length
    assert max(loads.values()) <= 4096


def test_run(spark):
    assert corpus_pipeline.run(spark, SF_DIR).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
