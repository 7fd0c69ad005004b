import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tallycast.llm import packing as P


def check(rows, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted((i is not None, i or 0, tokenizer.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in texts)
    by_doc = {}
    for r in sorted(rows, key=lambda r: (str(r.doc_id), r.sequence_id)):
        assert r.length == 1 << r.bucket and r.length <= 2048 and r.offset == 0
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) and len(r.ids) == r.length
        if r.start == 0:
            by_doc.setdefault(r.doc_id, []).append([])
        ids = by_doc[r.doc_id][-1]
        assert r.start == len(ids)
        ids += r.ids
        if len(ids) == r.doc_tokens:
            sizes = P.piece_lengths(r.doc_tokens, 2048)
            assert sum(sizes) == r.doc_tokens and sizes == sorted(sizes, reverse=True)
    assert sorted((i is not None, i or 0, ids) for i, docs in by_doc.items() for ids in docs) == want
    assert len({r.sequence_id for r in rows}) == len(rows)


def test_pieces_are_the_documents(spark, documents):
    check(P.pack(documents, with_ids=True).collect(), [(r.doc_id, r.text) for r in documents.collect()])


def test_hard_rows(spark, hard, none):
    check(P.pack(hard, with_ids=True).collect(), [(r.doc_id, r.text) for r in hard.collect()])
    assert P.pack(none).collect() == []
    odd = [(1, "a <|endoftext|> b"), (2, " " * 100_000), (3, "\r\n\t" * 3_000), (4, "word" * 20_000), (5, "漢" * 2_047 + "😀")]
    check(P.pack(spark.createDataFrame(odd, "doc_id long, text string"), with_ids=True).collect(), odd)


def test_lengths():
    assert P.piece_lengths(2048 + 7, 2048) == [2048, 4, 2, 1] and P.piece_lengths(1, 2048) == [1] and P.piece_lengths(4096, 2048) == [2048, 2048]


def test_no_shuffle(documents):
    plan = P.pack(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
