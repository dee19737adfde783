"""Byte-level BPE by the tiktoken library, from a local rank file.

The library splits a text by a pattern and merges each match on its own. A long text is cut first, at
places where every match must end, so that no call works on an unbounded text; the ids stay the same.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from tributary.llm.common import over_rows, texts

#: Code points after which a text is cut at the next safe place.
PART = 1 << 16
#: Code points from which on a run of white space in a long text is split off by hand: the library recurses on it.
RUN = 1 << 12
#: The characters of Unicode's White_Space, and how a pattern ends that splits runs of them as below.
_SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_RUNS_LAST = r"\s+(?!\S)|\s+"


@lru_cache(maxsize=4)
def encoding(rank_file: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file: on each line a base64 token and its rank. No special tokens."""
    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(rank_file, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_parts(text: str, part: int = PART) -> Iterator[str]:
    """Cut a text of over `part` code points where a match ends for certain.

    Such a place lies before one white-space character that stands between two letters or digits: what
    comes before cannot take in white space after a letter or digit, and the white space goes with what
    follows. This holds for patterns whose matches hold white space at their start only and look ahead
    only behind white space, as PATTERN of public_tokenizers. A text without such a place stays whole.
    """
    start, end = 0, len(text)
    while end - start > part:
        at = start + part
        while at < end - 1 and not (text[at].isspace() and text[at - 1].isalnum() and text[at + 1].isalnum()):
            at += 1
        if at >= end - 1:
            break
        yield text[start:at]
        start = at
    yield text[start:]


def encode(enc: tiktoken.Encoding, text: str, part: int = PART, run: int = RUN) -> list[int]:
    """The ids of a whole text, however long it and its runs of white space are.

    Where the pattern tries `\\s+(?!\\S)` and `\\s+` last, no match reaches into a run from before it, and a run of two and
    more is one match, less its last character if something follows, which then begins the next match.
    """
    if len(text) <= part:
        return enc.encode_ordinary(text)
    ids: list[int] = []
    start = 0
    if enc._pat_str.endswith(_RUNS_LAST):
        for found in re.finditer(f"[{_SPACES}]{{{run},}}", text):
            stop = found.end() - (found.end() < len(text))
            ids += _encode_parts(enc, text[start:found.start()], part)
            ids += enc._encode_single_piece(text[found.start():stop].encode())
            start = stop
    return ids + _encode_parts(enc, text[start:], part)


def _encode_parts(enc: tiktoken.Encoding, text: str, part: int) -> list[int]:
    ids: list[int] = []
    for piece in safe_parts(text, part):
        ids += enc.encode_ordinary(piece)
    return ids


def encode_documents(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of every whole text: (doc_id, ids array of int). Null text: no ids. One row per row, repeated ones too."""

    def run(batches):
        enc = encoding(rank_file, pattern)
        for batch in batches:
            ids = [encode(enc, t) for t in texts(batch, text_col)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=[id_col, "ids"])

    return over_rows(docs, [id_col, text_col], run, f"{id_col} long, ids array<int>")


def decode_documents(ids: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Raw bytes of every list of ids: (doc_id, data binary). Null ids: no bytes. Bytes need not be UTF-8."""

    def run(batches):
        enc = encoding(rank_file, pattern)
        for batch in batches:
            data = [enc.decode_bytes(x or []) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], names=[id_col, "data"])

    return over_rows(ids, [id_col, ids_col], run, f"{id_col} long, data binary")


def round_trip(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """Digests of encoding and decoding, text by text, in one pass.

    Returns doc_id, n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit integers), decoded_sha256,
    n_bytes, lossless. A null text counts as empty: 0 tokens and the digest of no bytes. Rows that repeat
    are returned as often; a null doc_id stays null. Texts of any length are encoded whole, long runs of white
    space included. An empty table gives an empty table. Other columns are not read, whatever their names.
    """

    def run(batches):
        enc = encoding(rank_file, pattern)
        for batch in batches:
            rows = []
            for text in texts(batch):
                ids = encode(enc, text)
                data = enc.decode_bytes(ids)
                rows.append((
                    len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                    hashlib.sha256(data).hexdigest(), len(data), data == text.encode(),
                ))
            columns = list(zip(*rows)) or [[]] * 5
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes", "lossless"],
            )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_bytes long, lossless boolean"
    return over_rows(docs, ["doc_id", "text"], run, schema)
