"""Encoding, decoding, counting and packing against the tokenizers library."""

import random
import zlib

import numpy as np
import pytest

from cropcube.llm import bpe_codec, packing, pretokens, token_counts
from cropcube.llm.bytebpe import Encoder, default_path, vocabulary
from tests.llm.brute import ids_digest, tokenizer

EDGES = ["", " ", "  a", "a  ", "don't 's's ''s 'll'll I'LL they've' 're", "x\n\n y\t\t z 　q", "<|endoftext|>",
         "a<|endoftext|><|endoftext|> b <|endoftext|", "é²½ ١٢٣ 漢字かな 😀😀 ́a", "a" * 500, "'", "' s", "!'s", " 's", "\n's",
         "...'re", "'stuff 'lly", "\x85\x1c\x1d a", "ab" * 500 + "c", " x y", "\x00\x01 �"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    alphabet = "aAbs t'rlevmd 1½²\n\t.!é漢  😀<|>endoftext"
    return EDGES + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 80))) for _ in range(4000)]


def test_encoder_equals_library(texts):
    enc, lib = Encoder(default_path()), tokenizer()
    got = [[] for _ in texts]
    for row, ids in enc.encode(texts):
        got[row] += ids.tolist()
    want = [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
    assert got == want
    for ids in want:
        assert enc.decode(np.array(ids, np.int64)).decode() == lib.decode(ids, skip_special_tokens=False)
    assert 0 < enc.merged < enc.words  # both the proposed and the merged way were taken


def test_long_text_in_pieces(monkeypatch):
    monkeypatch.setattr(pretokens, "BLOCK_CHARS", 50)
    rng = random.Random(1)
    text = "".join(rng.choice("ab  c\n'x 1") for _ in range(3000))
    assert "".join(pretokens.pieces(text, 50)) == text and len(list(pretokens.pieces(text, 50))) > 20
    got = [i for _, ids in Encoder(default_path()).encode([text]) for i in ids.tolist()]
    assert got == tokenizer().encode(text, add_special_tokens=False).ids


def test_compatible_pairs_equal_merging():
    v = vocabulary(default_path())
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 50000, 3000), rng.integers(0, 400, 3000)
    want = [v.merge(v.tokens[x] + v.tokens[y]) == [x, y] for x, y in zip(a, b)]
    assert v.compatible(a, b).tolist() == want and 0 < sum(want) < 3000


def test_lockstep_merging_equals_heap(texts):
    v = vocabulary(default_path())
    words = [t.encode()[:60] for t in texts if t]
    assert v.merge_all(words) == [v.merge(w) for w in words]


def test_classes_equal_library():
    from tokenizers import pre_tokenizers
    split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    kinds = pretokens.classes()
    points = [*range(0x3100), *range(0xA000, 0xA800), *range(0x1D7C0, 0x1D800), *range(0x1F600, 0x1F650),
              *range(0x10D40, 0x10D90), *range(0x2B730, 0x2B740), *range(0x323A0, 0x323C0), 0xE0100]
    for c in points:
        alone = [len(split(p + chr(c))) == 1 for p in "a1!"]
        want = alone.index(True) if any(alone) else pretokens.SPACE
        assert kinds[c] == want, hex(c)


@pytest.fixture(scope="module")
def docs(make_docs, texts):
    rows = [(i, t) for i, t in enumerate(texts[:300])] + [(900, None), (None, "no id"), (7, "repeated id"), (7, "repeated id")]
    rows.append((901, "long text, many words 12 " * 4000))
    return make_docs([(a, b, "x", 1) for a, b in rows], "doc_id long, text string, ids string, n_tokens int")


def test_encode_decode_rows(docs):
    lib = tokenizer()
    rows = bpe_codec.encode(docs, decoded=True).collect()
    want = sorted((r.doc_id is None, r.doc_id, ids_digest(e.ids), lib.decode(e.ids, skip_special_tokens=False))
                  for r in docs.collect() for e in [lib.encode(r.text or "", add_special_tokens=False)])
    import hashlib
    assert sorted((r.doc_id is None, r.doc_id, hashlib.sha256(r.ids).hexdigest(), r.decoded) for r in rows) == want
    again = bpe_codec.decode(bpe_codec.encode(docs), out="text").collect()
    assert sorted(r.text for r in again) == sorted(w[3] for w in want)


def test_counts(docs):
    lib = tokenizer()
    got = sorted((r.doc_id is None, r.doc_id, r.n_bytes, r.n_tokens, r.over_limit)
                 for r in token_counts.token_counts(docs, limit=1024).collect())
    want = []
    for r in docs.collect():
        n = len(lib.encode(r.text or "", add_special_tokens=False).ids)
        want.append((r.doc_id is None, r.doc_id, len((r.text or "").encode()), n, n > 1024))
    assert got == sorted(want)


def test_proven_strings():
    c = token_counts.counter(default_path())
    assert c.proven > 40_000
    assert c.count(["hello world", "qzxjqzxj"]).tolist() == [
        len(tokenizer().encode(t).ids) for t in ("hello world", "qzxjqzxj")]


def check_packed(rows, docs, capacity):
    """Pieces are those of the contract, and sequences are gapless and hold the capacity at most."""
    lib = tokenizer()
    want = []
    for r in docs:
        ids = lib.encode(r.text or "", add_special_tokens=False).ids + [0]
        start, k = 0, 0
        while start < len(ids):
            size = (len(ids) - start - 1) % capacity + 1 if not start else capacity
            part = np.array(ids[start:start + size], "<u4").tobytes()
            want.append((r.doc_id is None, r.doc_id, k, start, size, zlib.crc32(part)))
            start, k = start + size, k + 1
    got = [(r.doc_id is None, r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(got) == sorted(want)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_packing(docs):
    rows = packing.pack_documents(docs, capacity=64).collect()
    n = check_packed(rows, docs.collect(), 64)
    assert n == packing.lower_bound(np.array([r.length for r in rows]), 64)


def test_packing_in_many_groups(spark, monkeypatch):
    """Groups smaller than the table exchange documents and come near the bound; every row stays."""
    rng = np.random.default_rng(2)
    rows = [(int(i), int(x)) for i, x in enumerate(rng.integers(1, 60, 700))]
    out = packing.pack(spark.createDataFrame(rows, "doc_id long, length long"), 100, group_pieces=100).collect()
    assert sorted((r.doc_id, r.length) for r in out) == rows
    used = len({r.sequence_id for r in out})
    assert used <= packing.lower_bound(np.array([r[1] for r in rows]), 100) + 2


def test_packing_empty(make_docs):
    assert packing.pack_documents(make_docs([])).collect() == []


def test_best_fit_and_bound_against_exhaustive():
    rng = np.random.default_rng(4)

    def best(items, capacity):
        bins = [len(items)]

        def place(i, open_bins):
            if len(open_bins) >= bins[0]:
                return
            if i == len(items):
                bins[0] = len(open_bins)
                return
            for j in {b: k for k, b in enumerate(open_bins)}.values():
                if open_bins[j] + items[i] <= capacity:
                    open_bins[j] += items[i]
                    place(i + 1, open_bins)
                    open_bins[j] -= items[i]
            place(i + 1, [*open_bins, items[i]])
        place(0, [])
        return bins[0]

    for _ in range(40):
        items = rng.integers(1, 20, 8)
        least = best(sorted(items.tolist(), reverse=True), 20)
        where, offset = packing.best_fit_decreasing(items, 20)
        assert packing.lower_bound(items, 20) <= least <= where.max() + 1
        for b in range(where.max() + 1):
            own = sorted(zip(offset[where == b], items[where == b]))
            assert [o for o, _ in own] == np.cumsum([0] + [x for _, x in own])[:-1].tolist()
            assert sum(x for _, x in own) <= 20
    assert packing.lower_bound(np.array([11] * 5), 20) == 5  # over half the capacity each
