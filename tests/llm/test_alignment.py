import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from seedloom.llm import alignment
from seedloom.llm.arrays import byte_characters
from tests.llm.test_tokens import texts

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
MORE = ["▁x a", "<0x41> <s> </s> <unk>", " a", "a  b", "ﬁ ① Å", "\x00 \x7f", "a　b ​", "é é", "<|endoftext|> x"]


def token_bytes():
    to_byte = {shown: byte for byte, shown in enumerate(byte_characters())}
    a = Tokenizer.from_file(BYTES)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECES)

    def of_a(number):
        return bytes(to_byte[shown] for shown in a.id_to_token(number))

    def of_b(number):
        piece = b.id_to_piece(number)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(number) else piece.replace("▁", " ").encode()

    return a, b, of_a, of_b


def brute(rows):
    a, b, of_a, of_b = token_bytes()
    found, holders = [], collections.Counter()
    for doc_id, text in rows:
        want = (" " + text).encode() if text else b""
        a_ids = a.encode(" " + text, add_special_tokens=False).ids if text else []
        b_ids = b.encode(text) if text else []
        if b"".join(map(of_a, a_ids)) != want or b"".join(map(of_b, b_ids)) != want:
            a_ids = b_ids = []
        owner_a = [i for i, x in enumerate(a_ids) for _ in of_a(x)]
        owner_b = [j for j, x in enumerate(b_ids) for _ in of_b(x)]
        links = sorted(set(zip(owner_a, owner_b, strict=True)))
        ends = set(np.cumsum([len(of_a(x)) for x in a_ids]).tolist()) & set(np.cumsum([len(of_b(x)) for x in b_ids]).tolist())
        groups, at = [], 0
        for end in sorted(ends):
            own, other = dict.fromkeys(owner_a[at:end]), dict.fromkeys(owner_b[at:end])
            groups.append((tuple(a_ids[i] for i in own), tuple(b_ids[j] for j in other)))
            at = end
        pairs = [(a_ids[i], b_ids[j]) for i, j in links]
        holders.update(set(pairs))
        found.append((doc_id, len(a_ids), len(b_ids), groups, pairs))
    most = collections.Counter()
    for (x, _), n in holders.items():
        most[x] = max(most[x], n)
    out = []
    for doc_id, n_a, n_b, groups, pairs in found:
        shown = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        n_best = sum(holders[p] == most[p[0]] for p in pairs)
        digest = hashlib.sha256(shown.encode()).hexdigest() if n_a else ""
        out.append((doc_id, n_a, n_b, len(groups), len(pairs), n_best, sum(holders[p] for p in pairs), digest))
    return out, {doc_id: groups for doc_id, _, _, groups, _ in found}


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    words = ["the", "of", "tokenizer", "anti", "naïve", "北京", "x1", "don't", "ünder", "\n", "a.b", "12345"]
    plain = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 60))) for _ in range(80)]
    rows = list(enumerate(texts() + MORE + plain + plain[:5]))
    return [*rows, (3, "the of"), (None, "the of the of"), (5000, "the of naïve " * 20_000), (5001, "x" * 60_000)]


@pytest.mark.parametrize("block_bytes", [3000, alignment.BLOCK_BYTES])
def test_same_as_brute_force(spark, rows, block_bytes, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", block_bytes)
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, block int, n_a int").repartition(3)
    got = [tuple(r) for r in alignment.align_corpus(frame, BYTES, PIECES).collect()]
    assert ordered(got) == ordered(brute(rows)[0])


def test_groups_of_documents(spark, rows):
    chosen = [r for r in rows if r[0] not in (None, 3)]
    frame = spark.createDataFrame(chosen, "doc_id long, text string")
    got = {r.doc_id: r.groups for r in alignment.align_documents(frame, BYTES, PIECES).collect()}
    for doc_id, groups in brute(chosen)[1].items():
        assert [(tuple(g.a), tuple(g.b)) for g in got[doc_id]] == groups


def test_windows_with_one_hash_are_told_apart(monkeypatch):
    import pyarrow as pa

    text = pa.array(["the naïve tokenizer of the anti", "", "of of the"], pa.large_string())

    def found():
        own = alignment.Tokenizers(open(BYTES, encoding="utf-8").read(), open(PIECES, "rb").read())
        part = alignment.SliceAlignment(own, text)
        return part.groups, part.n_links.tolist(), part.pairs.tolist(), part.times.tolist()

    plain = found()
    monkeypatch.setattr(alignment, "_mixed", lambda ids, starts, counts, salt: np.zeros(len(starts), np.uint64))
    assert found() == plain


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align_corpus(frame, BYTES, PIECES).count() == 0
