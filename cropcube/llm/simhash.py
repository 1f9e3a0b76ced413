"""SimHash near-duplicates with BK-trees over distinct fingerprints.

The top of the tree is common to all: a few pivots, more of them the more fingerprints
there are, whose distances to a fingerprint name its shard.  Below, each shard has a BK-tree of bounded size
(children keyed by integer Hamming distance to the parent), kept as two arrays.
A query follows only edges within the radius: by the triangle inequality its
partners lie in shards whose pivot distances differ by the radius at most, and in
a tree under edges within the radius of its distance to the node.  Shard trees
travel to blocks of queries by an equi-join on the tree and a group of blocks, so a
large shard is searched by many tasks: a broadcast through the driver would have to
carry the fingerprints of all documents.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropcube.llm.common import as_bytes, mix64, ragged, slices, with_doc_id, written
from cropcube.llm.components import components, forest

SLICE_BYTES = 8 << 20
#: Members of one shard tree, and queries of one block.
TREE_SIZE = 16_384
#: Queries that search a tree at once, which bounds the links held in memory.
SEARCH_BLOCK = 512
EDGES = 65  # distances 0 to 64
#: Fewest and most pivots; each names some ten times as many shards and doubles the shards a query goes to.
PIVOTS = (3, 5)
#: Blocks of queries that meet a tree in one task.
BLOCKS_AT_ONCE = 8
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(raw: bytes, words: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of a text's word shingles; words are runs of bytes other than 0x20, 0x09-0x0D."""
    found = raw.translate(_LOWER).split()
    if not found:
        return 0
    if len(found) <= words:
        return xxhash.xxh64_intdigest(b" ".join(found), seed)
    size = np.array([len(w) for w in found])
    first = (np.cumsum(size) - size + np.arange(len(found))).tolist()
    last = (np.array(first) + size)[words - 1:].tolist()
    joined, h = b" ".join(found), xxhash.xxh64_intdigest
    values = np.array([h(joined[a:b], seed) for a, b in zip(first, last, strict=False)], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(values), 65_536):
        part = values[at:at + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > len(values)).tolist())


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id and fingerprint (long, the unsigned bits) of every whole text; a null text has none set."""

    def run(batches):
        for part in slices(batches, "text", SLICE_BYTES):
            raw, off = as_bytes(part.column("text"))
            data = raw.tobytes()
            got = [fingerprint(data[a:b], words) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(np.array(got, np.uint64).view(np.int64))], ["doc_id", "fp"])

    return with_doc_id(docs).mapInArrow(run, "doc_id long, fp long")


def bk_tree(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """BK-tree of distinct unsigned 64-bit values as (values in tree order, key of each node).

    Nodes stand level by level; a node's key is 65 * parent + distance to the parent
    (the root has -1), so keys rise and a node's children by distance are a range.
    """
    nodes, keys = [], []
    rest = values
    group = np.full(len(values), -1, np.int64)  # key of the place that each value goes to
    made = 0
    while len(rest):
        first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        size = np.diff(np.append(first, len(rest)))
        nodes.append(rest[first])
        keys.append(group[first])
        parent = np.repeat(made + np.arange(len(first)), size)
        distance = np.bitwise_count(rest ^ np.repeat(rest[first], size)).astype(np.int64)
        made += len(first)
        stay = np.ones(len(rest), bool)
        stay[first] = False
        rest, group = rest[stay], parent[stay] * EDGES + distance[stay]
        order = np.argsort(group, kind="stable")
        rest, group = rest[order], group[order]
    return np.concatenate([*nodes, values[:0]]), np.concatenate([*keys, group[:0]])


def search(nodes: np.ndarray, keys: np.ndarray, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(query number, node number) of all pairs within the radius."""
    q, at = np.arange(len(queries) if len(nodes) else 0), np.zeros(len(queries) if len(nodes) else 0, np.int64)
    hits = []
    while len(q):
        d = np.bitwise_count(nodes[at] ^ queries[q]).astype(np.int64)
        near = d <= radius
        hits.append((q[near], at[near]))
        low = np.searchsorted(keys, at * EDGES + np.maximum(d - radius, 0))
        high = np.searchsorted(keys, at * EDGES + np.minimum(d + radius, EDGES - 1), side="right")
        q, at = np.repeat(q, high - low), ragged(low, high - low)
    return tuple(np.concatenate([h[i] for h in hits]) if hits else np.zeros(0, np.int64) for i in (0, 1))


def pivots(n: int) -> list[int]:
    return [int(x) for x in mix64(np.arange(1, n + 1, dtype=np.uint64))]


def pivots_for(fingerprints: int) -> int:
    """Number of pivots for so many distinct fingerprints, so that most shards hold a tree or less."""
    return min(PIVOTS[1], max(PIVOTS[0], len(str(fingerprints // TREE_SIZE))))


def _shard(distances: list):
    """One number from the distances to the pivots; 70 exceeds any distance plus a radius."""
    key = F.lit(0).cast("long")
    for d in distances:
        key = key * 70 + d
    return key


def near_links(nodes: DataFrame, radius: int = 2) -> DataFrame:
    """Links (a, b: node ids) that join all fingerprints within the radius.

    ``nodes`` has distinct ``fp`` and its ``node``.  Within one pair of a tree and a
    block of queries, links are thinned to a spanning forest: as many components, never
    all pairs of a large group.
    """
    many = pivots_for(nodes.count())
    marks = [F.bit_count(F.col("fp").bitwiseXOR(F.lit(p - (1 << 64) if p >> 63 else p))).cast("long")
             for p in pivots(many)]
    keyed = nodes.select("fp", "node", _shard(marks).alias("own"))
    steps = range(-radius, radius + 1)
    moves = [m for m in itertools.product(steps, repeat=many) if len({x % 2 for x in m}) == 1]
    routes = sorted(r for m in moves if (r := sum(x * 70 ** (many - 1 - i) for i, x in enumerate(m))) >= 0)
    # "merge": an exploded table is many times its estimate, and broadcast it would pass whole through the driver
    size = written(keyed.groupBy(F.col("own").alias("shard")).agg(F.count("*").alias("n")), "shards")
    leads = size.select(F.col("shard").alias("own"), "n", F.explode(F.array(*[F.col("shard") + r for r in routes])).alias("shard"))
    asking = leads.groupBy("shard").agg(F.ceil(F.sum("n") / TREE_SIZE).alias("blocks")) \
        .join(size.select("shard", F.ceil(F.col("n") / TREE_SIZE).alias("trees")).hint("merge"), "shard")
    goes = leads.join(asking.hint("merge"), "shard").groupBy("own") \
        .agg(F.collect_list(F.struct("shard", "blocks", "trees")).alias("goes"))
    placed = keyed.join(written(goes, "shard-routes").hint("merge"), "own")
    home = F.get(F.filter("goes", lambda x: x["shard"] == F.col("own")), F.lit(0))
    members = placed.select(F.col("own").alias("shard"), "fp", "node", home.alias("home")) \
        .select("shard", F.pmod(F.xxhash64("fp"), F.col("home.trees")).alias("n"), "fp", "node",
                F.ceil(F.col("home.blocks") / BLOCKS_AT_ONCE).alias("groups")) \
        .repartition("shard", "n")  # the join left all trees of a shard in one partition
    asked = placed.select("own", "fp", "node", F.explode("goes").alias("to")).select(
        F.col("to.shard").alias("shard"), F.pmod(F.xxhash64("fp"), F.col("to.blocks")).alias("n"), "fp", "node",
        (F.col("own") == F.col("to.shard")).alias("own"), F.col("to.trees").alias("trees"))

    def plant(key, rows):
        fps = rows["fp"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(fps)
        fps, ids = fps[order], rows["node"].to_numpy(np.int64)[order]
        tree, keys = bk_tree(fps)
        ids = ids[np.searchsorted(fps, tree)]
        return pd.DataFrame({"shard": [key[0]], "t": [key[1]], "tree": [tree.tobytes()], "keys": [keys.tobytes()],
                             "ids": [ids.tobytes()], "groups": [rows["groups"].iloc[0]]})

    def block(key, rows):
        return pd.DataFrame({"shard": [key[0]], "g": [key[1] // BLOCKS_AT_ONCE], "fps": [rows["fp"].to_numpy(np.int64).tobytes()],
                             "nodes": [rows["node"].to_numpy(np.int64).tobytes()],
                             "own": [rows["own"].to_numpy(np.uint8).tobytes()], "trees": [rows["trees"].iloc[0]]})

    def find(batches):
        for batch in batches:
            for row in batch.to_pylist():
                tree, keys, ids = (np.frombuffer(row[c], t) for c, t in
                                   (("tree", np.uint64), ("keys", np.int64), ("ids", np.int64)))
                fps, asked_ids, own = (np.frombuffer(row[c], t) for c, t in
                                       (("fps", np.uint64), ("nodes", np.int64), ("own", np.uint8)))
                a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
                for at in range(0, len(fps), SEARCH_BLOCK):
                    q, m = search(tree, keys, fps[at:at + SEARCH_BLOCK], radius)
                    q = q + at
                    keep = (own[q] == 0) | (asked_ids[q] < ids[m])
                    a, b = forest(np.concatenate([a, asked_ids[q[keep]]]), np.concatenate([b, ids[m[keep]]]))
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    trees = members.groupBy("shard", "n").applyInPandas(
        plant, "shard long, t long, tree binary, keys binary, ids binary, groups long").withColumn("g", upto("groups")).drop("groups")
    asks = asked.groupBy("shard", "n").applyInPandas(
        block, "shard long, g long, fps binary, nodes binary, own binary, trees long").withColumn("t", upto("trees")).drop("trees")
    met = trees.join(asks.hint("merge"), ["shard", "t", "g"])
    return met.drop("shard", "t", "g").mapInArrow(find, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 2) -> DataFrame:
    """doc_id, fp and component_id (smallest doc_id reachable) of every document.

    One row for each row with a doc_id: rows without one have no identity and are left
    out.  Rows that repeat a doc_id keep their own fingerprint, and the doc_id is one
    node: its component joins what any of its rows links to.  Null, empty and blank
    texts have fingerprint zero and link like any other.  Other columns are not read.
    """
    fps = written(fingerprints(docs, words), "fingerprints")
    nodes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("node")), "fingerprint-nodes")
    # as many rows as documents on both sides, often in files that look small: never broadcast
    same = fps.join(nodes.hint("merge"), "fp").where("doc_id != node").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    repeated = fps.groupBy("doc_id").agg(F.min("fp").alias("f"), F.max("fp").alias("g")).where("f != g").select("doc_id")
    own = same.join(repeated, F.col("a") == F.col("doc_id"), "left_semi")
    linked = components(written(near_links(nodes, radius).unionByName(own), "near-links"))
    named = nodes.join(linked, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return fps.join(named.hint("merge"), "fp").select("doc_id", "fp", "component_id")


# The five primes of XXH64.
_PRIMES = (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)


def oracle(words: int = 3, radius: int = 2, seed: int = 42) -> str:
    """DuckDB SQL for the fingerprints and components of ``documents``, XXH64 included.

    Steps of the hash are a fold over a list of lanes (of 8, 4 and 1 bytes, the kind in the
    bits above 64); sums and products are taken in 128 bits, modulo 2 ** 64.
    """
    P, size = _PRIMES, 2 ** 64
    names = (f"x{i}" for i in itertools.count())

    def let(value, body):
        v = next(names)
        return f"list_transform([{value}], lambda {v}: {body(v)})[1]"
    word = lambda x: f"CAST(({x}) % {size}::UHUGEINT AS UBIGINT)"  # modulo 2 ** 64
    times = lambda x, p: word(f"CAST({x} AS UHUGEINT) * {p}::UHUGEINT")
    plus = lambda x, y: word(f"CAST({x} AS UHUGEINT) + CAST({y} AS UHUGEINT)")
    turn = lambda x, r: let(x, lambda v: f"({times(v, 2 ** r)} + ({v} >> {64 - r}))")
    step = lambda acc, lane: times(turn(plus(acc, times(lane, P[1])), 31), P[0])
    shift = lambda x, r: let(x, lambda v: f"xor({v}, {v} >> {r})")

    def lane(at, size):
        digits = " || ".join(f"substr(hex, 2 * ({at}) + {2 * i + 1}, 2)" for i in reversed(range(size)))
        return f"CAST('0x' || {digits} AS UBIGINT)"
    lanes = [f"list_reduce(list_prepend({(seed + a) % size}::UBIGINT, list_transform(range(n // 32), lambda s: {lane(f'32 * s + {8 * i}', 8)})), "
             f"lambda a, l: {step('a', 'l')})" for i, a in enumerate((P[0] + P[1], P[1], 0, -P[0]))]
    start = word(" + ".join(f"CAST({turn(f'v{i}', r)} AS UHUGEINT)" for i, r in enumerate((1, 7, 12, 18))))
    for i in range(4):
        start = plus(times(f"xor({start}, {step('0::UBIGINT', f'v{i}')})", P[0]), P[3])
    kinds = [f"list_transform(range(n % 32 // 8), lambda i: {size}::UHUGEINT + {lane('n // 32 * 32 + 8 * i', 8)})",
             f"list_transform(range(n % 8 // 4), lambda i: {2 * size}::UHUGEINT + {lane('n // 8 * 8', 4)})",
             f"list_transform(range(n % 4), lambda i: {3 * size}::UHUGEINT + {lane('n // 4 * 4 + i', 1)})"]
    h, value = "CAST(h AS UBIGINT)", word("e")
    rest = (f"CAST(CASE e // {size}::UHUGEINT WHEN 1 THEN {plus(times(turn(f'xor({h}, ' + step('0::UBIGINT', value) + ')', 27), P[0]), P[3])} "
            f"WHEN 2 THEN {plus(times(turn(f'xor({h}, ' + times(value, P[0]) + ')', 23), P[1]), P[2])} "
            f"ELSE {times(turn(f'xor({h}, ' + times(value, P[4]) + ')', 11), P[0])} END AS UHUGEINT)")
    last = shift(times(shift(times(shift(h, 33), P[1]), 29), P[2]), 32)
    return rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents WHERE doc_id IS NOT NULL),
s AS (
  SELECT row, CASE WHEN len(w) < {words} THEN array_to_string(w, ' ') ELSE array_to_string(w[p:p + {words - 1}], ' ') END AS s
  FROM (SELECT row, w, unnest(range(1, greatest(len(w) - {words - 2}, 2))) AS p FROM d WHERE len(w) > 0)),
own AS (SELECT row, s, count(*) AS many FROM s GROUP BY row, s),
text AS (SELECT s, hex(encode(s)) AS hex, octet_length(encode(s)) AS n FROM (SELECT DISTINCT s FROM s)),
lanes AS (SELECT *, {', '.join(f'CASE WHEN n >= 32 THEN {x} END AS v{i}' for i, x in enumerate(lanes))} FROM text),
begun AS (SELECT *, CAST({plus(f"CASE WHEN n >= 32 THEN {start} ELSE {seed + P[4]}::UBIGINT END", "n")} AS UHUGEINT) AS h0 FROM lanes),
mixed AS (SELECT s, list_reduce(list_prepend(h0, list_concat({', '.join(kinds)})), lambda h, e: {rest}) AS h FROM begun),
hashes AS (SELECT s, CAST({last} AS UBIGINT) AS h FROM mixed),
bits AS (
  SELECT row, b, 2 * sum(CASE WHEN (h >> b) & 1 = 1 THEN many ELSE 0 END) > sum(many) AS is_set
  FROM own JOIN hashes USING (s), range(64) AS r(b) GROUP BY row, b),
prints AS (SELECT row, CAST(sum(CASE WHEN is_set THEN CAST(1 AS HUGEINT) << CAST(b AS INTEGER) ELSE 0 END) AS UBIGINT) AS fp FROM bits GROUP BY row),
fps AS (SELECT doc_id, coalesce(fp, 0::UBIGINT) AS fp FROM d LEFT JOIN prints USING (row)),
nodes AS (SELECT fp, min(doc_id) AS node FROM fps GROUP BY fp),
links AS (SELECT a.fp AS a, b.fp AS b FROM nodes a JOIN nodes b ON a.fp <> b.fp AND bit_count(CAST(xor(a.fp, b.fp) AS HUGEINT)) <= {radius}),
reach AS (SELECT fp, fp AS other FROM nodes UNION SELECT reach.fp, links.b FROM reach JOIN links ON links.a = reach.other),
low AS (SELECT reach.fp, min(node) AS component_id FROM reach JOIN nodes ON nodes.fp = reach.other GROUP BY reach.fp)
SELECT doc_id, lower(lpad(to_hex(fp), 16, '0')) AS fingerprint, component_id FROM fps JOIN low USING (fp)"""
