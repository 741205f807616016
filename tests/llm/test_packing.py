import random
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from docquarry.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abcdenrst  \n\r\t'.,019éß中😀́\xa0 <|>endoftext", max_size=60), st.booleans())
def test_ids_equal_the_library(text, special):
    text = text + "<|endoftext|> b" if special else text
    assert packing.ids_of(PATH)(text).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_best_fit_takes_the_fullest_that_fits():
    bins = packing.BestFit(10, most_open=2)
    assert [bins.put(n) for n in (6, 7, 3, 4, 5)] == [(0, 0), (1, 0), (1, 7), (0, 6), (2, 0)]
    bins = packing.BestFit(10, most_open=2)
    assert [bins.put(n) for n in (6, 7, 8, 2, 4)] == [(0, 0), (1, 0), (2, 0), (2, 8), (0, 6)]  # 8 closed the bin of 7


def test_round_trip(spark):
    rng = random.Random(3)
    texts = [None, "", "x", "word " * 5000, "same text", "same text"] + [" ".join(rng.choice(["alpha", "beta", "gamma,", "δ"]) for _ in range(rng.randrange(1, 900))) for _ in range(60)]
    df = spark.createDataFrame([(i if i else None, t, 1) for i, t in enumerate(texts)] + [(7, texts[7], 1)], "doc_id long, text string, piece int")
    rows = packing.pack(df, PATH).collect()
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    total = 0
    for i, t in [*enumerate(texts)]:
        ids = np.array([*LIBRARY.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4")
        want, first = [], len(ids) % 1024 or 1024
        for k, at in enumerate([0, *range(first, len(ids), 1024)]):
            part = ids[at : first if k == 0 else at + 1024]
            want.append((k, at, len(part), zlib.crc32(part.tobytes())))
        times = 2 if i == 7 else 1
        total += times * len(ids)
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[i or None]) == sorted(want * times)
    for own in by_seq.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    assert len(by_seq) <= -(-total // 1024) + 3
    assert packing.pack(df.limit(0), PATH).count() == 0


def test_rows_that_are_the_same_are_dealt_to_all_packers(spark):
    df = spark.createDataFrame([(None, "same words here")] * 900 + [(5, "same words here")] * 300, "doc_id long, text string").repartition(4)
    rows = packing.pack(df, PATH, per_packer=100).collect()
    packers = {}
    for r in rows:
        packers[r.sequence_id >> 40] = packers.get(r.sequence_id >> 40, 0) + 1
    assert len(rows) == 1200 and len(packers) == 12 and max(packers.values()) < 200
