"""Packing by power-of-two decomposition.

A document's token sequence is cut into pieces whose lengths are powers of two:
as many of the full sequence length as fit, then one piece for each binary digit
of the rest.  Pieces of one length form a bucket, each piece is a sequence of its
own, so no sequence crosses documents and nothing is padded.

One scan: tokenising and cutting happen in the task that reads a document, and
sequences are numbered by task and row, so there is no shuffle at all and a task
that is run again gives the same rows.  Write the result with
``partitionBy("bucket")`` to train on one length at a time.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

END_ID = 1
END_OF_TEXT = "<|endoftext|>"
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, bucket int"
IDS_SCHEMA = SCHEMA + ", ids array<int>"


def encoder(vocabulary: str) -> Callable[[str], list[int]]:
    """Text to ids by the byte-level vocabulary ``vocabulary`` (.json; the same one as ranks lies beside it).

    The ids are those of ``tokenizers`` with ``add_special_tokens=False``;
    the rank-based encoder gives them several times faster and the other one
    takes the texts that it refuses.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(vocabulary.removesuffix(".json") + ".tiktoken", "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    slow: list[Tokenizer] = []

    def encode(text: str) -> list[int]:
        if END_OF_TEXT not in text:
            try:
                return fast.encode_ordinary(text)
            except Exception:  # the pattern engine's limit on very long runs
                pass
        if not slow:
            slow.append(Tokenizer.from_file(vocabulary))
        return slow[0].encode(text, add_special_tokens=False).ids

    return encode


def piece_lengths(n: int, longest: int) -> list[int]:
    """Powers of two, descending, that add up to n; ``longest`` (a power of two) is the largest."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


def pack(docs: DataFrame, vocabulary: str | None = None, longest: int = 2048, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, bucket (log2 of length), sequence_id, offset.

    Null or empty text: the end id alone, one piece of length 1.  Repeated rows
    are packed each for itself; a null doc_id stays null; extra columns of
    ``docs`` are not read; an empty table gives no rows.  ``with_ids`` adds
    the piece's ids.
    """
    if longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("byte_bpe_50k.json")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        names = [x.split()[0] for x in (IDS_SCHEMA if with_ids else SCHEMA).split(", ")]
        types = [pa.int64()] * 5 + [pa.int32()] + [pa.list_(pa.int32())] * with_ids
        rows: list[tuple] = []
        flush = lambda: pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = np.array(encode(text.as_py() or "") + [END_ID], dtype="<u4")
                doc, at = doc_id.as_py(), 0
                for length in piece_lengths(len(ids), longest):
                    part = ids[at:at + length]
                    row = (doc, at, length, zlib.crc32(part.tobytes()), len(ids), length.bit_length() - 1)
                    rows.append((*row, part.tolist()) if with_ids else row)
                    at += length
                if len(rows) >= 10_000:
                    yield flush()
                    rows = []
        if rows:
            yield flush()

    pieces = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        cut, IDS_SCHEMA if with_ids else SCHEMA)
    return pieces.withColumn("sequence_id", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
