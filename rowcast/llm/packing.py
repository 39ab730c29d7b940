"""Concatenate and cut: pack token streams into fixed windows.

Pass 1 tokenizes every document once, in the order of its input partition, and
writes (partition, offset within the partition, ids).  The partition totals are
the only thing that meets in one place: one number per partition.  Their prefix
sums turn local offsets into global ones, and pass 2 cuts each document at the
multiples of the window, without any shuffle.  A piece that reaches a window's
end carries ``boundary``: the document goes on in the next window.

Defined cases: a null or empty text is the single end id; repeated rows and
equal or null ids are packed one by one; an empty table gives no piece; extra
columns are ignored.  Documents lie whole in the stream in partition order, so
only the last window of a corpus is short.
"""

from __future__ import annotations

import base64
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

WINDOW = 2048
END_ID = 1

#: The vocabulary's split pattern without its look-ahead.  Texts
#: without two white-space characters in a row split alike under both.
FAST_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"

#: Characters on which both tokenizer libraries agree about classes.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e¡-¬®-ɏ]*")
_RUN = re.compile(r"\s\s")

TOKENS_DDL = "part int, first long, doc_id long, n long, ids binary"


class Tokenizer:
    """ids of ``tokenizers`` for a byte-level vocabulary, through the equal rank
    file where a text is plain; anything else goes through the JSON file."""

    def __init__(self, json_path: str, ranks_path: str | None):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer as Whole

        self.whole = Whole.from_file(json_path)
        self.fast = None
        if ranks_path:
            import tiktoken

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=FAST_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if (self.fast is not None and _PLAIN.fullmatch(text) and not _RUN.search(text) and "<|" not in text):
            return self.fast.encode_ordinary(text)
        return self.whole.encode(text, add_special_tokens=False).ids


def tokenized(docs: DataFrame, json_path: str, ranks_path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Pass 1: (part, first = tokens before it in its partition, doc_id, n, ids
    as little-endian uint32), written to the shared folder."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        tok, part, at = Tokenizer(json_path, ranks_path), TaskContext.get().partitionId(), 0
        for b in batches:
            first, n, ids = [], [], []
            for text in b.column("text").to_pylist():
                got = np.array(tok.ids(text) if text else [], dtype="<u4")
                body = np.append(got, np.uint32(end_id)).astype("<u4")
                first.append(at)
                n.append(len(body))
                ids.append(body.tobytes())
                at += len(body)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(n), pa.int32()), pa.array(first, pa.int64()), b.column("doc_id").cast(pa.int64()),
                 pa.array(n, pa.int64()), pa.array(ids, pa.binary())], names=["part", "first", "doc_id", "n", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return written(rows.mapInArrow(run, TOKENS_DDL), "tokens")


def pack(docs: DataFrame, json_path: str, ranks_path: str | None = None, window: int = WINDOW,
         end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian uint32),
    doc_tokens, sequence_id, offset, boundary."""
    tokens = tokenized(docs, json_path, ranks_path, end_id)
    # one row per input partition: bounded by the number of partitions, not by their contents
    totals = tokens.groupBy("part").agg(F.max(F.col("first") + F.col("n")).alias("total")).collect()
    base, at = {}, 0
    for r in sorted(totals, key=lambda r: r["part"]):
        base[r["part"]] = at
        at += r["total"]

    def cut(batches):
        import pyarrow as pa

        for b in batches:
            out = {k: [] for k in ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "boundary")}
            for part, first, doc, n, ids in zip(*(b.column(k).to_pylist() for k in ("part", "first", "doc_id", "n", "ids")),
                                                strict=True):
                g, start = base[part] + first, 0
                while start < n:
                    seq, off = divmod(g + start, window)
                    length = min(n - start, window - off)
                    for k, v in (("doc_id", doc), ("start", start), ("length", length),
                                 ("ids", ids[4 * start:4 * (start + length)]), ("doc_tokens", n), ("sequence_id", seq),
                                 ("offset", off), ("boundary", start + length < n)):
                        out[k].append(v)
                    start += length
            kinds = {"ids": pa.binary(), "boundary": pa.bool_()}
            yield pa.RecordBatch.from_arrays([pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items()],
                                             names=list(out))

    return tokens.mapInArrow(cut, "doc_id long, start long, length long, ids binary, doc_tokens long, "
                                  "sequence_id long, offset long, boundary boolean")
