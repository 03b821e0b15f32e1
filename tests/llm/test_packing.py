import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from ledgerline.llm import packing, tokens
from ledgerline.llm.words import texts


def corpus(seed=1):
    rng = random.Random(seed)
    chars = "abcdEFGÉßñ'’0123<|>!?…😀́  Σς"
    word = lambda: "".join(rng.choice(chars) for _ in range(rng.randrange(1, 14)))
    docs = [rng.choice([" ", "\n", "\t", "\r\n", "\x0b", "\x0c", "  "]).join(word() for _ in range(rng.randrange(0, 200))) for _ in range(60)]
    docs += [None, "", "  ", "\x01 a\x01b", "x<|endoftext|>y <|startoftext|>", "don't we'll I'M", "q" * 3000, "the cat " * 9000, " lead", "́a b́",
             "End. END!! e... f,,,, É, é.a b'. c,' 'd'. <|ENDOFTEXT|> 12, 1.5 a-b- x|> x<| (y) ß!!"]
    return docs + docs[:5]


def test_word_ids_equal_the_library():
    docs = corpus(3) * 3
    plain = Tokenizer.from_file(tokens.default_vocabulary())
    encode = tokens.WordTokenizer(tokens.default_vocabulary())
    got = []
    for t in texts(pa.array(docs, pa.string()), slice_bytes=2000):
        ids, bounds = encode(t)
        got += [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert got == [plain.encode(d or "", add_special_tokens=False).ids for d in docs]


def test_full_word_table_and_missing_mark(monkeypatch):
    monkeypatch.setattr(tokens, "SLOTS_LOG2", 3)
    docs = corpus(4)
    plain = Tokenizer.from_file(tokens.default_vocabulary())
    encode = tokens.WordTokenizer(tokens.default_vocabulary())
    encode.mark = None
    for _ in range(2):
        got = []
        for t in texts(pa.array(docs, pa.string()), slice_bytes=500):
            ids, bounds = encode(t)
            got += [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        assert got == [plain.encode(d or "", add_special_tokens=False).ids for d in docs]


@pytest.mark.parametrize("max_length", [4096, 64, 1])
def test_pieces_cover_every_document_once(spark, max_length):
    docs = [(i, d) for i, d in enumerate(corpus())] + [(None, "no id"), (3, "again 3")]
    frame = spark.createDataFrame([(i, d, 1, 2) for i, d in docs], "doc_id long, text string, length int, ids int")
    rows = packing.pack(frame.repartition(3), max_length=max_length).collect()
    plain = Tokenizer.from_file(tokens.default_vocabulary())
    want = sorted((str(i), plain.encode(d or "", add_special_tokens=False).ids + [2]) for i, d in docs)
    assert len({r.sequence_id for r in rows}) == len(rows)
    assert all(r.length & (r.length - 1) == 0 and r.length <= max_length and r.offset == 0 for r in rows)
    assert all(1 << r.bucket == r.length == len(r.ids) // 4 for r in rows)
    # Pieces of a document follow one another in their partition, from start 0 up.
    got, open_ = [], None
    for r in sorted(rows, key=lambda r: r.sequence_id):
        ids = np.frombuffer(r.ids, "<u4").tolist()
        if r.start == 0:
            open_ = [str(r.doc_id), []]
            got.append(open_)
        assert r.start == len(open_[1])
        open_[1] += ids
    assert sorted((a, b) for a, b in got) == want
    digest = {(r.doc_id, r.start, r.length, r.ids_crc32) for r in packing.digests(frame, max_length=max_length).collect()}
    assert digest == {(r.doc_id, r.start, r.length, zlib.crc32(r.ids)) for r in rows}
    by_doc = defaultdict(set)
    for r in rows:
        by_doc[r.doc_id].add(r.doc_tokens)
    assert by_doc[0] == {len(next(w for i, w in want if i == "0"))}


def test_empty_table(spark, tmp_path):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert packing.digests(frame).collect() == []
    packing.write_buckets(packing.pack(spark.createDataFrame([(1, "a b c")], "doc_id long, text string")), str(tmp_path / "b"))
    assert spark.read.parquet(str(tmp_path / "b")).count() == 1
