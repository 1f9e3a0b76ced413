"""Scenes held as blocks (J04, T06): one row for each scene, asset and block of cells.

A block is a square of cells of a tile's grid.  Its row has the values from the first to
the last cell with data, row by row, as an int array; cells without data are null inside
and left out at the ends.  Where few of these cells have data, the row has only the values
there and their places (``cells``), so a block takes no more than a few times its data.
Samples are grouped by the block that they lie in, meet a scene's block by an equi-join, all
assets at once, and pick their values by index.  No cell that is not sampled ever becomes a row.

Cells move once, packed, to the partition of their (tile, year, block) (:func:`gathered`);
blocks are made, their assets put side by side and stored by :func:`write_blocks` in buckets
of the same key where they lie.  The join reads the buckets: the samples are shuffled to
them, the pixels never are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from cropcube import constants as K
from cropcube.functions.hof import let, record
from cropcube.session import shared_path, shared_table

#: Cells of a block's side.
BLOCK_CELLS = 256
#: A block holds the places of its values if its span is above SHORT and above SPARSE times its cells with data.
SHORT, SPARSE = 64, 4
BLOCK_KEY = ["mgrs", "year", "block_row", "block_col"]
SCENE_KEY = ["scene_id", "mgrs", "year", "scene_date", "seq", "delivery"]


def block_of(row: Column, col: Column, size: int = BLOCK_CELLS) -> dict[str, Column]:
    """The block that a cell lies in and its index there; cells left of or above the grid have negative blocks."""
    n = F.lit(size)
    return {"block_row": F.floor(row / n).cast("int"), "block_col": F.floor(col / n).cast("int"),
            "at": (F.pmod(row, n) * n + F.pmod(col, n)).cast("int")}


def gathered(pixels: DataFrame, assets=tuple(K.ASSETS), size: int = BLOCK_CELLS, buckets: int | None = None) -> DataFrame:
    """Cells of scenes (row, col, a column for each asset) with their block and place, all cells of a
    (tile, year, block) in one partition.

    This is the one exchange of pixels: all later steps group by more than its key.  Rows are
    packed for it, four values of 16 bits a word, and sorted, so what neighbours share takes little.
    """
    buckets = buckets or int(pixels.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = pixels.withColumns(block_of(F.col("row"), F.col("col"), size)).drop("row", "col")
    rest = [c for c in placed.columns if c not in assets]
    packed = all(placed.schema[a].dataType == IntegerType() for a in assets)
    if packed:
        placed = placed.select(*rest, *_pack(assets))
    order = [*BLOCK_KEY, *[c for c in SCENE_KEY if c in rest and c not in BLOCK_KEY]]
    moved = placed.sortWithinPartitions(*order).repartition(buckets, *BLOCK_KEY)
    return moved.select(*rest, *_unpack(assets)) if packed else moved


#: Values of a word, and the code of a null.
_IN_WORD, _NULL = 4, 65_535


def _pack(assets) -> list[Column]:
    """Values of 16 bits, several a word; where one of a row is greater or negative, the whole row as it is."""
    code = lambda a: F.coalesce(F.col(a), F.lit(_NULL)).cast("long")
    small = F.lit(True)
    for a in assets:
        small = small & F.coalesce((F.col(a) >= 0) & (F.col(a) < _NULL), F.lit(True))
    words = []
    for i in range(0, len(assets), _IN_WORD):
        word = code(assets[i])
        for k, a in enumerate(assets[i + 1:i + _IN_WORD], 1):
            word = word.bitwiseOR(F.shiftleft(code(a), 16 * k))
        words.append(F.when(small, word).alias(f"_w{i // _IN_WORD}"))
    return [*words, F.when(~small, F.array(*assets)).alias("_wide")]


def _unpack(assets) -> list[Column]:
    value = lambda i: F.shiftrightunsigned(f"_w{i // _IN_WORD}", 16 * (i % _IN_WORD)).bitwiseAND(F.lit(_NULL)).cast("int")
    return [F.when(F.col("_wide").isNotNull(), F.get("_wide", F.lit(i))).otherwise(F.nullif(value(i), F.lit(_NULL))).alias(a)
            for i, a in enumerate(assets)]


def to_blocks(pixels: DataFrame, scene=tuple(SCENE_KEY), assets=tuple(K.ASSETS), size: int = BLOCK_CELLS) -> DataFrame:
    """Cells of scenes (row, col and a column for each asset, or such cells :func:`gathered`) as blocks.

    One aggregation on (scene, block), of at most size x size cells.  Where a scene gives a
    cell more than once, the greatest values stay.  ``values`` are those of the cells from
    ``first`` on, or, where ``cells`` is not null, those of these cells.
    """
    cells = pixels if "block_row" in pixels.columns else gathered(pixels, assets, size)
    cells = cells.groupBy(*scene, "block_row", "block_col").agg(F.array_sort(F.collect_list(F.struct("at", *assets))).alias("_cells"))
    once = let(F.col("_cells"), lambda cs: F.filter(
        cs, lambda c, i: F.coalesce(F.get(cs, i + 1)["at"] != c["at"], F.lit(True))))
    empty = F.slice(F.col("_cells"), 1, 0)  # an array of no cells, to have its type

    def filled(cs):
        gap = lambda c, i: F.when(i == 0, F.lit(0)).otherwise(c["at"] - F.get(cs, i - 1)["at"] - 1)
        return F.flatten(F.transform(cs, lambda c, i: F.concat(F.array_repeat(F.get(empty, F.lit(0)), gap(c, i)), F.array(c))))

    def stored(cs):
        span = F.element_at(cs, -1)["at"] - F.get(cs, F.lit(0))["at"] + 1
        sparse = span > F.greatest(F.lit(SHORT), F.lit(SPARSE) * F.size(cs))
        return record(first=F.get(cs, F.lit(0))["at"], cells=F.when(sparse, F.transform(cs, lambda c: c["at"])),
                      values=F.when(sparse, cs).otherwise(filled(cs)))

    cells = cells.select(*scene, "block_row", "block_col", let(once, stored).alias("_block"))
    rows = F.array(*[record(asset=F.lit(a), first=F.col("_block.first"), cells=F.col("_block.cells"), values=F.col("_block.values")[a])
                     for a in assets])
    return cells.select(*scene, "block_row", "block_col", F.inline_outer(rows))


def write_blocks(blocks: DataFrame, buckets: int | None = None) -> DataFrame:
    """Blocks stored in the shared folder in buckets of (tile, year, block), and read back: a row for each
    scene and block, with a column for each asset.  Blocks that lie by this key already are not moved."""
    spark = blocks.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = shared_table("blocks")
    _whole(blocks.repartition(buckets, *BLOCK_KEY)).write.option("path", shared_path(spark, "blocks")) \
        .option("compression", "zstd").bucketBy(buckets, *BLOCK_KEY).sortBy(*BLOCK_KEY).saveAsTable(name)
    return spark.table(name)


def _whole(blocks: DataFrame, assets=tuple(K.ASSETS)) -> DataFrame:
    """The assets of each scene's block side by side: one row, and the places once."""
    key = [c for c in blocks.columns if c not in ("asset", "first", "cells", "values")]
    whole = blocks.groupBy(*key).agg(
        F.first("first").alias("first"), F.first("cells").alias("cells"),  # the same for all assets
        F.collect_list(F.struct("asset", "values")).alias("_assets"))
    return whole.select(*key, "first", "cells", *[F.get(F.filter("_assets", _named(a)), F.lit(0))["values"].alias(a) for a in assets])


def observe_blocks(cells: DataFrame, blocks: DataFrame, wanted: DataFrame | None = None,
                   scene=tuple(SCENE_KEY), assets=tuple(K.ASSETS), exclude=tuple(K.SCL_EXCLUDE), size: int = BLOCK_CELLS) -> DataFrame:
    """The value of every asset of every scene at every sample, from blocks.

    ``cells`` are samples with the (row, col) of each covering tile (``observe.sample_cells``);
    ``wanted``, where given, names the scenes to read (mgrs, year, scene_date, seq).  A sample
    outside every block, or where the scene has no data or an excluded scene class, gives no
    row.  A group of samples is bounded by the cells of a block, the wanted scenes of a tile
    and year by its dates.  A scene's block looks its cells up among the samples' where it
    holds their places, and the samples' among its own where it does not: the work is that
    of the cells with data, not samples by scenes by assets.
    """
    keep = [c for c in cells.columns if c not in ("mgrs", "year", "row", "col")]
    place = block_of(F.col("row"), F.col("col"), size)
    samples = cells.select("mgrs", "year", *[v.alias(k) for k, v in place.items()], *keep).groupBy(*BLOCK_KEY) \
        .agg(F.collect_list(F.struct("at", *keep)).alias("_samples"))
    samples = samples.select(*BLOCK_KEY, _by_cell(F.col("_samples")).alias("_s"))
    if wanted is not None:
        samples = samples.join(wanted.groupBy("mgrs", "year").agg(
            F.collect_set(F.struct("scene_date", "seq")).alias("_wanted")), ["mgrs", "year"])
    rest = [c for c in scene if c not in BLOCK_KEY]
    whole = _whole(blocks, assets) if "asset" in blocks.columns else blocks
    of = {a: f"_v{i}" for i, a in enumerate(assets)}
    whole = whole.select(*BLOCK_KEY, *rest, F.col("first").alias("_first"), F.col("cells").alias("_cells"),
                         *[F.col(a).alias(c) for a, c in of.items()])
    met = whole.join(samples, BLOCK_KEY)
    if wanted is not None:
        met = met.where(F.array_contains("_wanted", F.struct("scene_date", "seq")))
    s = F.col("_s")
    dense = F.transform(s["ats"], lambda a, g: record(i=a - F.col("_first"), g=g))
    sparse = F.transform("_cells", lambda a, i: record(i=i, g=F.get(s["index"], a - s["ats"][0])))
    scl = lambda h: F.get(F.col(of["scl"]), h["i"])
    seen = F.filter(F.when(F.col("_cells").isNull(), dense).otherwise(sparse),
                    lambda h: h["g"].isNotNull() & scl(h).isNotNull() & ~scl(h).isin(list(exclude)))
    rows = F.flatten(F.transform(seen, lambda h: F.transform(F.get(s["groups"], h["g"]), lambda x: record(
        **{k: x[k] for k in keep}, **{a: F.get(F.col(c), h["i"]) for a, c in of.items()}))))
    return met.select("mgrs", "year", *rest, F.inline_outer(rows)).where(F.col("scl").isNotNull())


def _by_cell(samples: Column) -> Column:
    """Samples of a block: their cells in order (``ats``), the samples of each (``groups``), and the number of
    its group for every cell from the first to the last (``index``, null where there is no sample)."""
    def grouped(found, order):
        starts = F.filter(F.transform(order, lambda o, i: F.when((i == 0) | (o["at"] != F.get(order, i - 1)["at"]), i)), lambda i: i.isNotNull())
        return let(starts, lambda at: record(
            ats=F.transform(at, lambda i: F.get(order, i)["at"]),
            groups=F.transform(at, lambda i, g: F.transform(
                F.slice(order, i + 1, F.coalesce(F.get(at, g + 1), F.size(order)) - i), lambda o: F.get(found, o["i"])))))

    def indexed(by):
        gap = lambda a, g: F.when(g == 0, F.lit(0)).otherwise(a - F.get(by["ats"], g - 1) - 1)
        return record(ats=by["ats"], groups=by["groups"], index=F.flatten(F.transform(by["ats"], lambda a, g: F.concat(
            F.array_repeat(F.lit(None).cast("int"), gap(a, g)), F.array(g)))))

    order = lambda found: F.array_sort(F.transform(found, lambda x, i: record(at=x["at"], i=i)))
    return let(let(samples, lambda found: let(order(found), lambda o: grouped(found, o))), indexed)


def _named(asset: str):
    return lambda x: x["asset"] == asset
