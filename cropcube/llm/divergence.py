"""Source divergence audit: how each source of a language differs in its use of terms.

Terms are counted by length-bucketed packing (see terms).  One aggregation over the
occurrences, combined in blocks and tasks before it is shuffled, gives the counts of
(lang, source, term); all that follows works on distinct terms.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cropcube.llm.common import written
from cropcube.llm.terms import partial_counts

COUNTS = "lang string, source string, term string, n long, docs long"
#: Sources in one side of a tile of pairs, rows of a tile (about), and terms that it takes at once.
TILE, TILE_ROWS, TERMS_AT_ONCE = 64, 20_000, 4096
#: Parts of a group's terms that are ranked before the whole group is.
PARTS = 32


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and docs (documents with it) over whole texts.

    Null text, lang and source are read as ''.
    """
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return rows.mapInArrow(partial_counts, COUNTS).groupBy("lang", "source", "term") \
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, vocabulary: Column, smoothing: int, scale: int) -> Column:
    """1 + floor(scale * (count + smoothing) / (total + smoothing * vocabulary)), exact."""
    whole = "decimal(38,0)"
    top = (F.lit(scale).cast("decimal(12,0)") * (count + smoothing).cast("decimal(20,0)")).cast(whole)
    below = (total.cast("decimal(20,0)") + F.lit(smoothing).cast("decimal(10,0)") * vocabulary.cast("decimal(20,0)")).cast(whole)
    return F.lit(1).cast("long") + F.call_function("div", top, F.when(below > 0, below))


def audit(docs: DataFrame, min_docs: int = 30, smoothing: int = 5, scale: int = 1_000_000_000, top: int = 50) -> DataFrame:
    """lang, source, part, item, value and rank (from 1) for every occurring (lang, source).

    A lang keeps the V terms that ``min_docs`` of its documents hold.  Each group, and each
    lang, gives a kept term the share p = 1 + floor(scale * (n + smoothing) / (N + smoothing
    * V)); n is its count there, 0 included, N that of all kept terms.  Part ``pair``: every
    other source of the lang with the sum over kept terms of the difference of both shares
    (0 if V = 0).  Part ``term``: the ``top`` kept terms of which the group has any and a
    larger share than its lang, with the difference.  Ranks go by value, largest first, then
    item in UTF-8 order.

    Null text, lang and source are read as '' and such rows count like others; texts without
    terms make their group occur; repeated rows count each; an empty table gives no rows;
    other columns are not read.  A lang's sources meet in tiles of bounded size, dealt by
    blocks of terms, so neither a large lang nor many sources come together in a task.
    """
    spark = docs.sparkSession
    counts = written(term_counts(docs), "term-counts")
    kept = written(counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
                   .where(F.col("docs") >= min_docs).drop("docs"), "kept-terms")
    rows = written(counts.drop("docs").join(kept, ["lang", "term"]), "kept-counts")
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    totals = rows.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("terms"))
    zero = F.lit(0).cast("long")
    groups = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct() \
        .join(totals, ["lang", "source"], "left").join(langs, "lang", "left") \
        .select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("total", "terms", "v", "lang_total")]) \
        .withColumn("number", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1) \
        .withColumn("none", F.coalesce(share(zero, F.col("total"), F.col("v"), smoothing, scale), zero)) \
        .withColumn("tile", F.floor(F.col("number") / TILE).cast("int"))
    groups = written(groups, "groups")
    p = share(F.col("n"), F.col("total"), F.col("v"), smoothing, scale)
    q = share(F.col("lang_n"), F.col("lang_total"), F.col("v"), smoothing, scale)
    rows = rows.join(groups, ["lang", "source"]).withColumn("p", p).withColumn("q", q)

    def ranked(df, *keys, by=("lang", "source")):
        best = Window.partitionBy(*by, *keys).orderBy(F.col("value").desc(), "item")
        return df.withColumn("rank", F.row_number().over(best))

    more = rows.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"),
                                      F.pmod(F.xxhash64("term"), F.lit(PARTS)).alias("part_of_group"))
    first = ranked(more, "part_of_group").where(F.col("rank") <= top).drop("rank", "part_of_group")
    terms = ranked(first).where(F.col("rank") <= top).withColumn("part", F.lit("term"))

    # each tile of two blocks of sources takes a block of terms at a time; headers name all its sources
    tiles = groups.groupBy("lang").agg((F.max("tile") + 1).alias("tiles"),
                                       F.ceil((F.sum("terms") + 1) / TILE_ROWS).alias("blocks"))
    dealt = rows.select("lang", "tile", "number", "none", "term", "p").join(tiles, "lang") \
        .withColumn("block", F.pmod(F.xxhash64("term"), "blocks")).drop("blocks")
    heads = groups.select("lang", "tile", "number", "none").join(tiles, "lang") \
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))) \
        .select("lang", "tile", "number", "none", F.lit(None).cast("string").alias("term"), F.lit(None).cast("long").alias("p"),
                "tiles", "block")
    met = dealt.unionByName(heads).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))) \
        .withColumn("a", F.least("tile", "other")).withColumn("b", F.greatest("tile", "other")) \
        .select("lang", "block", "a", "b", "tile", "number", "none", "term", "p")
    part = met.groupBy("lang", "block", "a", "b").applyInArrow(_tile, "lang string, x int, y int, more long")
    sums = part.groupBy("lang", "x", "y").agg(F.sum("more").alias("more"))
    side = groups.select("lang", "number", "source", "none", "v")
    pairs = sums.join(side.select("lang", F.col("number").alias("x"), "source", F.col("none").alias("none_x"), "v"), ["lang", "x"]) \
        .join(side.select("lang", F.col("number").alias("y"), F.col("source").alias("item"), F.col("none").alias("none_y")), ["lang", "y"]) \
        .withColumn("value", F.col("v") * F.abs(F.col("none_x") - F.col("none_y")) + F.col("more")) \
        .select("lang", "value", F.explode(F.array(F.struct("source", "item"), F.struct(
            F.col("item").alias("source"), F.col("source").alias("item")))).alias("way")) \
        .select("lang", "way.*", "value")
    pairs = ranked(pairs).withColumn("part", F.lit("pair"))
    return pairs.select("lang", "source", "part", "item", "value", "rank") \
        .unionByName(terms.select("lang", "source", "part", "item", "value", "rank"))


def _tile(key, rows):
    """For the sources of two blocks: what the terms at hand add to V times the difference of
    the shares of a term that neither has."""
    a, b = key[2].as_py(), key[3].as_py()
    number, tile, p, none = (rows.column(c).to_numpy() for c in ("number", "tile", "p", "none"))
    head = rows.column("term").is_null().to_numpy()
    here = np.sort(number[head])
    base = np.zeros(len(here), np.int64)
    base[np.searchsorted(here, number[head])] = none[head]
    on_a = np.isin(here, number[head & (tile == a)])
    at_a, at_b = np.flatnonzero(on_a), np.flatnonzero(~on_a) if a != b else np.arange(len(here))
    total = np.zeros((len(at_a), len(at_b)), np.int64)
    flat = np.abs(base[at_a][:, None] - base[at_b][None])
    word = rows.column("term").combine_chunks().dictionary_encode()
    code = word.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    source, value = np.searchsorted(here, number), p
    for begin in range(0, len(word.dictionary), TERMS_AT_ONCE):
        size = min(TERMS_AT_ONCE, len(word.dictionary) - begin)
        pick = np.flatnonzero((code >= begin) & (code < begin + size))
        grid = np.repeat(base[:, None], size, axis=1)
        grid[source[pick], code[pick] - begin] = value[pick].astype(np.int64)
        for i, row in enumerate(at_a):
            total[i] += np.abs(grid[at_b] - grid[row]).sum(axis=1) - size * flat[i]
    x, y = np.meshgrid(here[at_a], here[at_b], indexing="ij")
    pick = x < y if a == b else np.ones(x.shape, bool)
    n = int(pick.sum())
    return pa.table({"lang": pa.array([key[0].as_py()] * n, pa.string()), "x": pa.array(x[pick], pa.int32()),
                     "y": pa.array(y[pick], pa.int32()), "more": pa.array(total[pick], pa.int64())})


def oracle(min_docs: int = 30, smoothing: int = 5, scale: int = 1_000_000_000, top: int = 50) -> str:
    """DuckDB SQL for :func:`audit` over the table ``documents``."""
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
groups AS (SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
kept AS (SELECT lang, term, count(*) AS n FROM d GROUP BY lang, term HAVING count(DISTINCT row) >= {min_docs}),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
found AS (SELECT lang, source, term, count(*) AS n FROM d GROUP BY ALL),
cells AS (
  SELECT g.lang, g.source, k.term, coalesce(f.n, 0) AS n, k.n AS lang_n FROM groups g JOIN kept k USING (lang)
  LEFT JOIN found f ON f.lang = g.lang AND f.source = g.source AND f.term = k.term),
totals AS (SELECT lang, source, sum(n) AS total FROM cells GROUP BY ALL),
shares AS (
  SELECT lang, source, term, n,
         CAST(1 + ({scale}::HUGEINT * (n + {smoothing})) // (t.total + {smoothing} * l.v)::HUGEINT AS BIGINT) AS p,
         CAST(1 + ({scale}::HUGEINT * (lang_n + {smoothing})) // (l.total + {smoothing} * l.v)::HUGEINT AS BIGINT) AS q
  FROM cells JOIN totals t USING (lang, source) JOIN langs l USING (lang)),
sums AS (
  SELECT a.lang, a.source, b.source AS item, CAST(sum(abs(a.p - b.p)) AS BIGINT) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (FROM pairs UNION ALL FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {top}"""
