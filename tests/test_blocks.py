"""Scenes as blocks: samples pick the values that their cells hold."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cropcube import constants as K
from cropcube.operators import blocks as BL

SCENE = "scene_id string, mgrs string, year int, scene_date date, seq int, delivery int"
PIXELS = f"{SCENE}, row int, col int, " + ", ".join(f"{a} int" for a in K.ASSETS)
CELLS = "name string, mgrs string, year int, row int, col int"


def _random(seed=5):
    import datetime as dt
    rng = random.Random(seed)
    scenes = [(f"s{i}", rng.choice(["AF", "NO"]), 1997, dt.date(1997, 1, 1 + i), i % 3, 0) for i in range(6)]
    pixels = {}
    for s in scenes:
        for _ in range(rng.randrange(1, 60)):
            pixels[s, rng.randrange(-9, 20), rng.randrange(-9, 20)] = [rng.choice([0, 4, 5, 8]), *[rng.randrange(10 ** 4) for _ in K.BANDS]]
    cells = [(f"p{i}", rng.choice(["AF", "NO", "XX"]), 1997, rng.randrange(-12, 25), rng.randrange(-12, 25)) for i in range(400)]
    cells += [("twin", *cells[0][1:])]
    return [(*s, r, c, *v) for (s, r, c), v in pixels.items()], cells


def _expected(pixels, cells, wanted=None):
    at = defaultdict(list)
    for p in pixels:
        at[p[1], p[2], p[6], p[7]].append(p)
    return sorted((m, y, p[0], p[3], p[4], p[5], n, *p[8:]) for n, m, y, r, c in cells for p in at[m, y, r, c]
                  if p[8] not in K.SCL_EXCLUDE and (wanted is None or (p[3], p[4]) in wanted))


@pytest.mark.parametrize("size", [1, 4, 256])
@pytest.mark.parametrize("narrowed", [False, True])
def test_samples_against_cells(spark, size, narrowed):
    pixels, cells = _random(size)
    blocks = BL.to_blocks(spark.createDataFrame(pixels, PIXELS).repartition(3), size=size)
    wanted = sorted({(p[1], p[2], p[3], p[4]) for p in pixels})[::2]
    names = spark.createDataFrame(wanted, "mgrs string, year int, scene_date date, seq int") if narrowed else None
    got = BL.observe_blocks(spark.createDataFrame(cells, CELLS), blocks, names, size=size)
    rows = sorted(map(tuple, got.select("mgrs", "year", "scene_id", "scene_date", "seq", "delivery", "name", *K.ASSETS).collect()))
    assert rows == _expected(pixels, cells, {w[2:] for w in wanted} if narrowed else None) and (rows or narrowed)


def test_blocks_hold_every_cell_once(spark):
    pixels, _ = _random()
    again = [(*p[:8], p[8], *[v - 1 for v in p[9:]]) for p in pixels[::3]]  # a cell given twice keeps the greatest values
    blocks = BL.to_blocks(spark.createDataFrame(pixels + again, PIXELS), size=4)
    rows = blocks.where("asset = 'red'").select("scene_id", "block_row", "block_col", F.posexplode("values").alias("i", "red"), "first") \
        .where("red IS NOT NULL").collect()
    red = PIXELS.split(", ").index("red int")
    got = {(r.scene_id, r.block_row * 4 + (r["first"] + r.i) // 4, r.block_col * 4 + (r["first"] + r.i) % 4): r.red for r in rows}
    assert got == {(p[0], p[6], p[7]): p[red] for p in pixels}
    ends = blocks.agg(F.bool_and(F.col("values")[0].isNotNull() & F.element_at("values", -1).isNotNull())).first()[0]
    assert ends and blocks.groupBy("scene_id", "block_row", "block_col").count().where(f"count <> {len(K.ASSETS)}").count() == 0


def test_pixels_are_neither_shuffled_nor_exploded(spark):
    pixels, cells = _random()
    blocks = BL.write_blocks(BL.to_blocks(spark.createDataFrame(pixels, PIXELS), size=4))
    got = BL.observe_blocks(spark.createDataFrame(cells, CELLS), blocks, size=4)
    with_joins = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where neither side is small
        plan = BL.observe_blocks(spark.createDataFrame(cells, CELLS), blocks, size=4)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", with_joins)
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan  # the samples, to the buckets
    assert plan.count("Generate") == 1 and "Generate inline" in plan.split("SortMergeJoin")[0]  # rows of samples, after the join
    assert sorted(map(tuple, got.select("name", "scene_id").collect())) == sorted((r[6], r[2]) for r in _expected(pixels, cells))


def test_nothing_to_read(spark):
    pixels, cells = _random()
    none = spark.createDataFrame([], PIXELS)
    assert BL.observe_blocks(spark.createDataFrame(cells, CELLS), BL.to_blocks(none)).collect() == []
    assert BL.observe_blocks(spark.createDataFrame([], CELLS), BL.to_blocks(spark.createDataFrame(pixels, PIXELS))).collect() == []


def test_sparse_blocks_keep_places_not_gaps(spark):
    import datetime as dt
    s = ("s", "AF", 1997, dt.date(1997, 1, 1), 1, 0)
    far = [(*s, r, c, 4, *[r + c] * len(K.BANDS)) for r, c in [(0, 0), (100, 7), (255, 255)]]  # 3 cells in a span of 65,536
    full = [(*s[:5], 1, 0, c, 4, *[c] * len(K.BANDS)) for c in range(100)]
    blocks = BL.to_blocks(spark.createDataFrame(far + full, PIXELS))
    sizes = {(r.delivery, r.n, r.c) for r in blocks.select("delivery", F.size("values").alias("n"), F.size("cells").alias("c")).collect()}
    assert {(d, n) for d, n, _ in sizes} == {(0, 3), (1, 100)} and {c for d, _, c in sizes if d == 0} == {3}
    cells = spark.createDataFrame([("a", "AF", 1997, 100, 7), ("b", "AF", 1997, 0, 99), ("c", "AF", 1997, 255, 255),
                                   ("twin", "AF", 1997, 100, 7), ("none", "AF", 1997, 100, 8)], CELLS)
    got = BL.observe_blocks(cells, blocks).select("name", "delivery", "red").collect()
    assert sorted(map(tuple, got)) == [("a", 0, 107), ("b", 1, 99), ("c", 0, 510), ("twin", 0, 107)]


def test_cells_move_once_however_they_are_stored(spark, sf_small):
    """Cells go to the partition of their block; numbering, blocks and assets are made there, and nothing moves to the buckets."""
    from cropcube.sources import fixtures as FX
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    plan = FX.scene_blocks(spark, sf_small).repartition(buckets, *BL.BLOCK_KEY)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Window" in plan


def test_packed_values_come_back(spark):
    import datetime as dt
    odd = [None, 0, 1, -1, 9999, 65534, 65535, 65536, 2 ** 31 - 1, -2 ** 31]
    rng = random.Random(7)
    rows = [("s", "AF", 1997, dt.date(1997, 1, 1), 1, 0, i, -i, *[rng.choice(odd[:5] if i % 2 else odd) for _ in K.ASSETS]) for i in range(200)]
    got = BL.gathered(spark.createDataFrame(rows, PIXELS))
    assert {f.name: f.dataType.typeName() for f in got.schema if f.name in K.ASSETS} == dict.fromkeys(K.ASSETS, "integer")
    cells = {(r.block_row * 256 + r["at"] // 256, r.block_col * 256 + r["at"] % 256): tuple(r[a] for a in K.ASSETS) for r in got.collect()}
    assert cells == {r[6:8]: r[8:] for r in rows}


def test_stored_blocks_hold_their_places_once(spark):
    pixels, _ = _random()
    blocks = BL.to_blocks(spark.createDataFrame(pixels, PIXELS), size=4)
    stored = BL.write_blocks(blocks)
    assert stored.count() * len(K.ASSETS) == blocks.count() > 0
    key = [*BL.SCENE_KEY, "block_row", "block_col"]
    got = {tuple(r[k] for k in key): r for r in stored.collect()}
    for r in blocks.collect():
        one = got[tuple(r[k] for k in key)]
        assert (one["first"], one["cells"], one[r.asset]) == (r["first"], r["cells"], r["values"])
