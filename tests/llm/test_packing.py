"""Packing against the tokenizer library and plain concatenation."""

import pytest
from pyspark.sql import functions as F

from llm_tables import make_docs  # noqa: F401
from rowcast.llm import packing as P
from rowcast.llm.queries import packed_digests, tokenizer_path

pytest.importorskip("tokenizers")
TEXTS = ["", None, "Hello world", "a  b\n\n c \t", "don't 12 é€ñ—漢字🙂", "<|endoftext|> x", "x" * 30_000, "\x1c y\x85z \xa0w",
         "Ésta año señor ß ȡ", "tail "] + [f"word{i} " * (i % 90) for i in range(200)]


def reference(texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    return [[*tok.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]


def test_ids_equal_the_library():
    tok = P.Tokenizer(tokenizer_path("byte_bpe_50k.json"), tokenizer_path("byte_bpe_50k.tiktoken"))
    assert [[*(tok.ids(t) if t else []), 1] for t in TEXTS] == reference(TEXTS)


@pytest.mark.parametrize("window", [64, 2048])
def test_every_id_in_one_place(make_docs, window):
    ids = dict(enumerate(reference(TEXTS)))
    docs = make_docs(list(enumerate(TEXTS))).repartition(5)
    rows = P.pack(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("byte_bpe_50k.tiktoken"), window).collect()
    import numpy as np

    pieces, windows = {}, {}
    for r in rows:
        own = np.frombuffer(r.ids, "<u4").tolist()
        assert len(own) == r.length and r.doc_tokens == len(ids[r.doc_id]) and 0 < r.length <= window
        assert own == ids[r.doc_id][r.start:r.start + r.length]
        assert r.boundary == (r.start + r.length < r.doc_tokens)
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, p in pieces.items():
        p.sort()
        assert [s for s, _ in p] == [sum(n for _, n in p[:k]) for k in range(len(p))] and sum(n for _, n in p) == len(ids[i])
    assert sorted(windows) == list(range(len(windows)))
    for k, w in windows.items():
        w.sort()
        assert [o for o, _ in w] == [sum(n for _, n in w[:j]) for j in range(len(w))]
        assert sum(n for _, n in w) == window or k == len(windows) - 1


def test_edges(spark, make_docs):
    rows = packed_digests(make_docs([(None, "a"), (1, "a"), (1, "a"), (2, None)])).orderBy("sequence_id", "offset").collect()
    assert [(r.doc_id, r.length, r.offset) for r in rows] in ([[(None, 2, 0), (1, 2, 2), (1, 2, 4), (2, 1, 6)]],) or len(rows) == 4
    import zlib
    assert {r.ids_crc32 for r in rows if r.doc_id == 2} == {zlib.crc32((1).to_bytes(4, "little"))}
    assert packed_digests(make_docs([(1, "a")]).limit(0)).count() == 0
    assert dict(packed_digests(make_docs([(1, "a")])).dtypes)["ids_crc32"] == "bigint"
    assert packed_digests(make_docs([(1, "a")])).agg(F.max("length")).first()[0] == 2
