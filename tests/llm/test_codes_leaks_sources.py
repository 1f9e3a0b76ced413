"""Vector codes, benchmark leaks and the source audit against plain versions."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cropcube.llm import decontam, divergence, lloyd, terms
from tests.llm.conftest import DOCS

# vector codes


def _plain_codes(rows, parts, entries, rounds):
    """(codes, errors, books) of integer vectors in order of place."""
    width = len(rows[0]) // parts
    cut = [[tuple(v[p * width:(p + 1) * width]) for v in rows] for p in range(parts)]
    books = [c[:entries] for c in cut]

    def near(x, book):
        d = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in book]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        for p in range(parts):
            own = defaultdict(list)
            for x in cut[p]:
                own[near(x, books[p])[0]].append(x)
            books[p] = [tuple(sum(c) // len(own[e]) for c in zip(*own[e])) if own[e] else b for e, b in enumerate(books[p])]
    found = [[near(cut[p][i], books[p]) for p in range(parts)] for i in range(len(rows))]
    return [[e for e, _ in f] for f in found], [sum(d for _, d in f) for f in found], books


@pytest.mark.parametrize("size", ["usual", "huge"])
def test_codes_against_plain(spark, size):
    rng = random.Random(size)
    unit = 1 if size == "usual" else 1e30
    vectors = [[round(rng.gauss(0, 1), 3) * unit for _ in range(8)] for _ in range(70)]
    vectors += [vectors[3]] * 9  # copies
    ids = rng.sample(range(1000), len(vectors))
    ids[5] = ids[4]  # one id on two vectors
    rows = [(i, v, rng.choice([None, 1, 2]), "x") for i, v in zip(ids, vectors)]
    bad = [(1, None, 1, ""), (2, [1.0] * 7 + [float("nan")], 1, ""), (3, [1.0] * 7 + [None], 1, ""), (4, [float("inf")] * 8, 1, ""),
           (5, [], 1, ""), (6, [1.0] * 4, 2, ""), (7, [0.0] * 3, 2, "")]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, label int, row string")
    found = lloyd.compress(df.repartition(3), parts=4, entries=5, rounds=2, scale=256)
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0], rows[i][1]))
    whole = [[int(np.floor(256 * x)) if abs(x) < 1e6 else int(x) * 256 for x in rows[i][1]] for i in order]
    codes, errors, books = _plain_codes(whole, 4, 5, 2)
    longest = 2 ** 63 - 1
    by_label = Counter()
    for i, e in zip(order, errors):
        by_label[rows[i][2]] += e
    want = [(rows[i][0], rows[i][2], c, min(e, longest), min(by_label[rows[i][2]], longest)) for i, c, e in zip(order, codes, errors)]
    key = lambda r: repr(tuple(r))
    assert sorted(map(tuple, found.rows.collect()), key=key) == sorted(want, key=key)
    assert [[tuple(map(int, c)) for c in b] for b in found.books] == books


def test_codes_of_nothing_and_hot_entry(spark):
    none = spark.createDataFrame([(1, None, 1)], "vec_id long, embedding array<float>, label int")
    found = lloyd.compress(none)
    assert found.rows.collect() == [] and found.books == []
    one = spark.createDataFrame([(i, [0.5] * 16, 7) for i in range(300)], "vec_id long, embedding array<float>, label int")
    rows = lloyd.compress(one, entries=2).rows.collect()
    assert len(rows) == 300 and {(tuple(r.code), r.error) for r in rows} == {((0,) * 16, 0)}


def test_members_stay_with_their_owner():
    rng = np.random.default_rng(2)
    members = rng.integers(-50, 50, (500, 3))
    books = [rng.integers(-50, 50, (6, 3))]
    entry, _ = lloyd.nearest(members, books[0])
    blocks = lloyd._batch(list(lloyd._grouped(0, entry, np.arange(500), members, 3)), lloyd.BLOCK)
    moved = pa.Table.from_batches(lloyd._reassign(books, 3, iter([blocks]))).column("moved").to_pylist()
    assert not any(moved)
    shifted = [books[0] + rng.integers(-9, 9, (6, 3))]
    out = pa.Table.from_batches(lloyd._reassign(shifted, 3, iter([blocks]))).to_pylist()
    change = int((lloyd.nearest(members, shifted[0])[0] != entry).sum())
    assert 0 < change < 500 and sum(r["members"] for r in out if r["moved"]) == change
    assert sorted(i for r in out for i in np.frombuffer(r["rows"], np.int64)) == list(range(500))


# benchmark leaks

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _plain_leaks(docs, items, window):
    windows = defaultdict(set)
    for i, text in items:
        w = _words(text)
        m = min(window, len(w))
        for p in range(len(w) - m + 1) if w else ():
            windows[tuple(w[p:p + m])].add(i)
    out = []
    for i, text in docs:
        w, hit, found = _words(text), set(), set()
        for m in {len(k) for k in windows}:
            for p in range(len(w) - m + 1):
                if (k := tuple(w[p:p + m])) in windows:
                    hit |= set(range(p, p + m))
                    found |= {str(x) for x in windows[k] if x is not None}
        runs = [x for x in sorted(hit) if x - 1 not in hit]
        out.append((i, len(w), [(s, next(e for e in range(s, len(w) + 1) if e not in hit)) for s in runs], sorted(found)))
    return out


def _leaky(rng):
    vocabulary = [f"w{i}" for i in range(12)] + ["été", "Ñandú", "漢字", "A1", "b"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 3, 5, 9, 10, 11, 30]))) for i in range(40)]
    items += [(7, items[20][1]), (None, text(14)), (50, ""), (51, None), (52, "--- !"), (100, items[3][1].upper())]
    docs = [(i, " ".join([text(rng.randrange(60)), rng.choice(items)[1] or "", text(9)]).replace(" ", rng.choice([" ", ", ", "\n\t", "--"])))
            for i in range(60)]
    return docs + [(None, "w1"), (3, None), (3, ""), (4, " \x00 "), (4, items[0][1]), (4, items[0][1])], items


@pytest.mark.parametrize("per_pass", [200_000, 150])
def test_leaks_against_plain(spark, per_pass):
    docs, items = _leaky(random.Random(11))
    got = decontam.contaminated(
        spark.createDataFrame([(i, t, 1, "") for i, t in docs], "doc_id long, text string, spans int, item_ids string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"), window=10, pass_windows=per_pass)
    rows = [(r.doc_id, r.n_words, [tuple(s) for s in r.spans], list(r.item_ids)) for r in got.collect()]
    assert sorted(map(repr, rows)) == sorted(map(repr, _plain_leaks(docs, items, 10)))


def test_leaks_of_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontam.contaminated(none, items).collect() == []
    no_items = decontam.contaminated(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), items.where("false")).collect()
    assert [(r.n_words, r.spans, r.item_ids) for r in no_items] == [(2, [], [])]


def test_long_text_in_parts(monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 64)
    rng = random.Random(4)
    item = " ".join(rng.choice("abcdefgh") * rng.randrange(1, 4) for _ in range(25))
    text = " ".join(rng.choice("abcdefgh") * rng.randrange(1, 4) for _ in range(700))
    text = f"{text} {item} {text[::-1]} {'x' * 500} {item} {item} {text}"
    windows = pa.Table.from_batches(decontam._windows(10, iter([pa.record_batch({"item": ["5"], "text": [item]})])))
    index = decontam.Index(windows.select(["words", "item"]))
    tokens = index.tokens()
    batch = pa.record_batch({"doc_id": [1], "text": [text], "spans": pa.array([[]], decontam._SPANS),
                             "item_ids": pa.array([[]], pa.list_(pa.string()))})
    counted = pa.Table.from_batches(decontam._count(tokens, 9, iter([batch])))
    plain = Counter(tuple(_words(text)[i:i + 4]) for i in range(len(_words(text)) - 3))
    own = {tuple(_words(item)[i:i + 4]) for i in range(22)}
    assert sum(counted.column("n").to_pylist()) == sum(plain[k] for k in own)
    index.prefixes(tokens, counted)
    (out,) = decontam._probe(index, 9, ["doc_id"], iter([batch]))
    row = out.to_pylist()[0]
    ((_, n, spans, found),) = _plain_leaks([(1, text)], [(5, item)], 10)
    assert (row["n_words"], [(s["start"], s["end"]) for s in row["spans"]], row["item_ids"]) == (n, spans, found) and len(spans) == 2


# source audit

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def _plain_audit(docs, min_docs, top):
    docs = [(t or "", lang or "", s or "") for t, lang, s in docs]
    found = [Counter(TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t))) for t, _, _ in docs]
    out = []
    for lang in {x for _, x, _ in docs}:
        seen, count, by = Counter(), Counter(), defaultdict(Counter)
        for (_, x, s), c in zip(docs, found):
            if x == lang:
                seen.update(set(c))
                count.update(c)
                by[s].update(c)
        kept = sorted(k for k, n in seen.items() if n >= min_docs)
        share = lambda c, v=len(kept), kept=kept: {
            k: 1 + 10 ** 9 * (c[k] + 5) // (sum(c[x] for x in kept) + 5 * v) for k in kept}
        q, p = share(count), {s: share(c) for s, c in by.items()}
        for s in by:
            pairs = sorted((-sum(abs(p[s][k] - p[t][k]) for k in kept), t.encode()) for t in by if t != s)
            more = sorted((q[k] - p[s][k], k.encode()) for k in kept if by[s][k] and p[s][k] > q[k])[:top]
            out += [(lang, s, part, k.decode(), -v, i + 1) for part, rows in (("pair", pairs), ("term", more))
                    for i, (v, k) in enumerate(rows)]
    return out


def test_audit_against_plain(spark, make_docs, monkeypatch):
    rng = random.Random(6)
    words = [f"{rng.choice('abcdefg')}{'xyzé漢'[rng.randrange(5)] * rng.choice([0, 1, 5, 7, 8, 15, 16, 17, 40])}" for _ in range(60)]
    docs = [(" ".join(rng.choice(words) for _ in range(rng.randrange(40))).replace(" ", rng.choice([" ", "_1@", "[`{"])).title(),
             rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "S2", "é", None])) for _ in range(150)]
    docs += [(None, "en", "empty"), ("", "xx", "a"), ("...", "xx", "b"), ("one", None, "lonely"), ("e" * 5000, "en", "s1")] * 2
    monkeypatch.setattr(divergence, "TILE", 2)
    monkeypatch.setattr(divergence, "TILE_ROWS", 20)
    df = make_docs([(1, *r, 0, "") for r in docs], "doc_id long, text string, lang string, source string, n_chars long, term string")
    got = divergence.audit(df.repartition(4), min_docs=5, top=7).collect()
    want = _plain_audit(docs, 5, 7)
    assert sorted(map(tuple, got)) == sorted(want) and {r.part for r in got} == {"pair", "term"}


def test_audit_of_empty_tables(make_docs):
    assert divergence.audit(make_docs([], DOCS)).collect() == []
    got = divergence.audit(make_docs([(1, "a b", "en", s, 3) for s in ("x", "y")], DOCS)).collect()
    assert sorted(map(tuple, got)) == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]


def test_terms_of_long_text_in_pieces(monkeypatch):
    monkeypatch.setattr(terms, "PIECE_BYTES", 50)
    text = " ".join(random.Random(3).choice(["Ab", "cde", "f" * 30, "été"]) for _ in range(300))
    batch = pa.record_batch({"lang": ["en"], "source": ["s"], "text": [text]})
    rows = pa.Table.from_batches(terms.partial_counts(iter([batch]))).to_pylist()
    assert {r["term"]: (r["n"], r["docs"]) for r in rows} == {k: (n, 1) for k, n in Counter(text.lower().split()).items()}


def test_radix_order():
    rng = np.random.default_rng(1)
    words = [rng.integers(0, 3, 500).astype(np.uint64) << np.uint64(40), rng.integers(0, 2 ** 63, 500).astype(np.uint64)]
    assert terms.radix_order(words).tolist() == np.lexsort(words[::-1]).tolist()


def test_shares_are_exact(spark):
    n, total, v = 3 * 10 ** 11, 10 ** 13 + 7, 10 ** 6 + 1
    c = divergence.share(F.lit(n), F.lit(total), F.lit(v), 5, 10 ** 9)
    assert spark.range(1).select(c).first()[0] == 1 + 10 ** 9 * (n + 5) // (total + 5 * v)
