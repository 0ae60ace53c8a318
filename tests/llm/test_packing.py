import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from kpi_shift.llm import packing
from kpi_shift.llm.queries import tokenizer_path
from tests.llm.helpers import clashing, documents, prose

ODD = ["It's DON'T we'll", "<|endoftext|>x", "É×÷ ß ﬁ Ω Σς İ", "a b c\x1cd\x85e", "1234 a1b2 !!'s ''s", "日本語 テスト", "ª º µ", "é ñ é", "👍🏽", "x\x00y\x7f"]


def check(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_pieces_are_the_tokenizer_s_ids(spark):
    texts = [*ODD, None, "", " ", prose(4000, 1), "same", "same"]
    rows = packing.pack_documents(clashing(documents(spark, texts)), tokenizer_path()).collect()
    known = Tokenizer.from_file(tokenizer_path())
    for i, text in enumerate(texts):
        ids = np.array([*known.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        parts = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in rows if r.doc_id == i)
        cuts = range(0, len(ids), 2048)
        assert parts == [(k, at, len(ids[at : at + 2048]), zlib.crc32(ids[at : at + 2048].tobytes())) for k, at in enumerate(cuts)]
    check(rows, 2048)
    with_ids = packing.tokenized_pieces(documents(spark, ["a b"]), tokenizer_path(), with_ids=True).first()
    assert with_ids.ids == [*known.encode("a b").ids, 0]
    assert packing.pack_documents(documents(spark, []), tokenizer_path()).count() == 0


def test_groups_and_levels_fill_sequences(spark):
    rng = random.Random(5)
    lengths = [rng.choice([rng.randrange(1, 100), rng.randrange(1, 1001)]) for _ in range(3000)] + [1000] * 5
    rows = [(i // 2 if i % 50 else None, i % 2, n, "x") for i, n in enumerate(lengths)]
    pieces = spark.createDataFrame(rows, "doc_id bigint, piece int, length bigint, extra string")
    packed = packing.pack(pieces, 1000, open_bins=16, group_rows=300)
    got = packed.collect()
    assert sorted(r.length for r in got) == sorted(lengths) and "extra" in packed.columns
    least = -(-sum(lengths) // 1000)
    assert check(got, 1000) <= 1.03 * least
    assert sorted(map(tuple, packing.pack(pieces, 1000, open_bins=16, group_rows=300).collect()), key=repr) == sorted(map(tuple, got), key=repr)


def test_best_fit_and_fullest_closes_first():
    bins, offsets, still = packing.best_fit([6, 5, 4, 3], 10, open_bins=2)
    assert (bins, offsets) == ([0, 1, 0, 1], [0, 0, 6, 5]) and still == {1}
    # the third bin closes the one with 7 of 10; then 3 fits only the bin with 6
    assert packing.best_fit([7, 6, 8, 3], 10, open_bins=2)[0] == [0, 1, 2, 1]
