"""Windows of byte-pair ids against a plain loop."""

import os

import pytest
from pyspark.sql import functions as F

from tidemill.functions.tokens import chunk_ids

tokenizers = pytest.importorskip("public_tokenizers")
RANKS = tokenizers.path("byte_bpe_50k.tiktoken")
pytestmark = pytest.mark.skipif(not os.path.exists(RANKS), reason="vocabulary not present")

TEXTS = [
    "Plain words, and more of them. " * 20, "naïve café 京都の寺 🙂🙃 Ünïcode" * 8, "🙂" * 50, "", None, "<|endoftext|> is ordinary", "x" * 5000, "  \n\t tabs   and spaces ", "a",
]


def plain(text, size):
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    bpe = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = bpe.encode_ordinary(text)
    data = text.encode()
    out, at = [], 0
    for i in range(0, len(ids), size):
        window = ids[i:i + size]
        stop = at + sum(len(bpe.decode_single_token_bytes(t)) for t in window)
        # letters whose first byte lies in the window
        first = len(data[:at].decode(errors="ignore")) + (at > 0 and at < len(data) and data[at] & 0xC0 == 0x80)
        last = len(data[:stop].decode(errors="ignore")) + (stop < len(data) and data[stop] & 0xC0 == 0x80)
        out.append((len(window), first, text[first:last]))
        at = stop
    return out


@pytest.mark.parametrize("size", [1, 7, 500])
def test_equal_a_plain_loop(spark, size):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string").withColumn("_w", F.lit("kept"))
    rows = chunk_ids(df, "text", RANKS, tokenizers.PATTERN, size).collect()
    for i, text in enumerate(TEXTS):
        own = sorted((r for r in rows if r.id == i), key=lambda r: r.chunk_no)
        assert [r.chunk_no for r in own] == list(range(len(own)))
        assert "".join(r.chunk_text for r in own) == (text or "")
        assert [(r.n_tokens, r.start_char, r.chunk_text) for r in own] == plain(text or "", size)
        assert all(r["_w"] == "kept" for r in own)


def test_texts_are_taken_in_parts(spark, monkeypatch):
    """However many texts a batch has, about ``PART_BYTES`` of them are held with their windows."""
    import pyarrow as pa

    from tidemill.functions import tokens

    monkeypatch.setattr(tokens, "PART_BYTES", 1000)
    texts = ["é" * n for n in (10, 300, 0, 5, 4000, 1, 200, 200, 200)] + [None] + ["abc"] * 2000
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["row", "text"])
    parts = list(tokens._text_parts(batch))
    assert [t for p in parts for t in p.column(1).to_pylist()] == texts and len(parts) > 6
    assert all(sum(len((t or "").encode()) for t in p.column(1).to_pylist()[1:]) <= 1000 for p in parts)
    assert list(tokens._text_parts(batch.slice(0, 0))) == []
    df = spark.createDataFrame([(i, "word " * 50, {"k": i}) for i in range(60)], "id int, text string, extra map<string,int>")
    assert chunk_ids(df, "text", RANKS, tokenizers.PATTERN, 7).filter("extra['k'] = id").select("id").distinct().count() == 60
