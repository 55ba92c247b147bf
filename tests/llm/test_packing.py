import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from seedloom.llm import packing
from tests.llm.test_tokens import WORDS, texts


def check(rows, lengths, capacity):
    """Every id once, sequences gapless, padding only in sequences that are no power of two."""
    by_doc, by_sequence = {}, {}
    for row in rows:
        by_doc.setdefault(row.doc_id, []).append(row)
        by_sequence.setdefault(row.sequence_id, []).append(row)
    assert {doc for doc, n in lengths.items() if n} == set(by_doc)
    for doc, pieces in by_doc.items():
        at = 0
        for piece in sorted(pieces, key=lambda p: p.start):
            assert piece.start == at and piece.length > 0 and piece.doc_tokens == lengths[doc]
            at += piece.length
        assert at == lengths[doc]
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for piece in sorted(pieces, key=lambda p: p.offset):
            assert piece.offset == at
            at += piece.length
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding, len(by_sequence), sum(len(pieces) > 1 for pieces in by_doc.values())


def test_packs_real_ids(spark):
    rows = [(i * 13 % 997, t) for i, t in enumerate(texts())] + [(2000, "word " * 9000), (None, "alone")]
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, ids int, start int").repartition(3)
    got = packing.pack_documents(frame, WORDS).collect()
    tokenizer = Tokenizer.from_file(WORDS)
    want = {d: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for d, t in rows}
    padding, _, _ = check(got, {d: len(ids) for d, ids in want.items()}, 4096)
    assert padding == 0
    for row in got:
        assert bytes(row.ids) == want[row.doc_id][row.start : row.start + row.length].tobytes()


def test_query_columns(spark):
    from seedloom.llm.queries import QUERIES

    got = QUERIES["op13_packing"](spark, "/root/testdata/sf0.001")
    assert set(got.columns) >= {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {d: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for d, t in docs.items()}
    rows = got.collect()
    assert check(rows, {d: len(ids) for d, ids in want.items()}, 4096)[0] == 0
    for row in rows:
        assert row.ids_crc32 == zlib.crc32(want[row.doc_id][row.start : row.start + row.length].tobytes())


def pieces(lengths):
    return [packing.Piece(i, 0, np.arange(n, dtype="<u4"), n) for i, n in enumerate(lengths)]


@pytest.mark.parametrize("seed", range(12))
def test_streams_of_any_lengths(seed):
    rng = random.Random(seed)
    draw = [lambda: 1, lambda: rng.randint(1, 300), lambda: rng.choice([1, 255, 256, 257, 3000]), lambda: int(rng.paretovariate(0.8))]
    lengths = [min(draw[seed % 4](), 20_000) for _ in range(rng.choice([0, 1, 5, 900]))]
    used = list(packing.sequences(iter(pieces(lengths)), 256, 8))
    seen = {}
    for sequence in used:
        size = sum(len(p.ids) for p in sequence)
        assert 0 < size <= 256 and (size == 256 or size & (size - 1) == 0)
        for p in sequence:
            seen.setdefault(p.doc_id, []).append((p.start, p.ids.tolist()))
    for doc, n in enumerate(lengths):
        assert sum((ids for _, ids in sorted(seen[doc])), []) == list(range(n))


def test_most_documents_stay_whole():
    rng = random.Random(5)
    lengths = [rng.randint(20, 2500) for _ in range(3000)]
    cut = {p.doc_id for s in packing.sequences(iter(pieces(lengths)), 4096) for p in s if not p.whole}
    assert len(cut) < 0.2 * len(lengths)


def test_differencing_balances_and_raises_the_window_count():
    bins, sums = packing.difference([8, 7, 6, 5, 4], 2)
    assert sorted(sums.tolist()) == [14, 16] and sorted(sum(bins, ())) == [0, 1, 2, 3, 4]
    bins, sums = packing.deal([60, 60, 60], 100)
    assert sums.tolist() == [60, 60, 60] and sorted(bins) == [(0,), (1,), (2,)]
    assert packing.deal([], 100)[1].tolist() == [0]


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_documents(frame, WORDS).count() == 0
    with pytest.raises(ValueError):
        packing.pack_documents(frame, WORDS, capacity=0)
