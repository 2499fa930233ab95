"""Documents as token pieces of bounded length, shared by the two packing operators.

The ids are those of a byte-level BPE vocabulary given as ranks. ``tiktoken`` computes them; the ``tokenizers``
library gives the same ids from the JSON form of the vocabulary at about a fifth of the speed (tests compare them),
and takes over for a text that the faster library refuses.
"""

from __future__ import annotations

import base64
import os
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flatwatch.llm.common import map_slices, texts

RANKS, JSON = "byte_bpe_50k.tiktoken", "byte_bpe_50k.json"
END_ID = 2


def encoder(ranks: str = RANKS, json: str = JSON) -> Callable[[str], np.ndarray]:
    """text -> uint32 ids; strings that look like special tokens are ordinary text."""
    import tiktoken

    with open(public_tokenizers.path(ranks), "rb") as f:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})
    slow = []

    def other(text: str) -> np.ndarray:
        if not slow:
            from tokenizers import Tokenizer

            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            slow.append(Tokenizer.from_file(public_tokenizers.path(json)))
            slow[0].encode_special_tokens = True
        return np.array(slow[0].encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(text: str) -> np.ndarray:
        try:
            return fast.encode_to_numpy(text, disallowed_special=()).astype(np.uint32, copy=False)
        except BaseException as e:                  # the Rust panic of a regex limit is no Exception
            if type(e).__name__ != "PanicException":
                raise
            return other(text)

    return encode


def piece_bounds(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: all but the first have ``size``."""
    first = n - (n - 1) // size * size
    return [(0, first)] + [(s, size) for s in range(first, n, size)]


def token_pieces(docs: DataFrame, size: int, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text",
                 ids: str | None = None, make_encoder: Callable = encoder) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every row: ids of the text, then ``end_id``.

    A document of more than ``size`` ids is cut into pieces of ``size``, the first one shorter if need be; others are
    one piece. Null and empty texts are the end id alone. ``ids``: the type in which the piece's ids are given, ``<u2`` or
    ``<u4``; checksums are always those of ``<u4``.
    """
    if size < 1:
        raise ValueError("size must be positive")
    fields = [T.StructField("doc_id", docs.schema[doc_id].dataType)] + T._parse_datatype_string(
        "piece int, start long, length long, ids_crc32 long" + (", ids binary" if ids else "")).fields

    def setup():
        encode = make_encoder()

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            row, out = [], []
            for i, t in enumerate(texts(batch.column("text"))):
                found = np.append(encode(t), np.uint32(end_id)).astype("<u4")
                for n, (s, k) in enumerate(piece_bounds(len(found), size)):
                    part = found[s:s + k]
                    row.append(i)
                    out.append((n, s, k, zlib.crc32(part.tobytes()), part.astype(ids).tobytes() if ids else None))
            cols = list(zip(*out))
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][:5 if ids else 4]
            return pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(row)),
                                               *(pa.array(c, k) for c, k in zip(cols, kinds))], names=[f.name for f in fields])
        return one

    return map_slices(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), None, T.StructType(fields), setup)
