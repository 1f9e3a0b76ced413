"""Observations: pixels x scenes, de-duplication and quality filters.

J01 attach_class_names, J12 sample_cells, F06 drop_scl, F07 drop_incomplete,
W03-style keep-latest as a combinable aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropcube import constants as K
from cropcube.functions.hof import let, record

MAX_DICTIONARY_ROWS = 256  # class codes are 8-bit raster values


def latest_per_key(df: DataFrame, keys: list[str], order: list[str],
                   values: list[str] | None = None) -> DataFrame:
    """Keep one row per ``keys``: the one with the greatest ``order`` tuple.

    Written as ``max(struct(order..., values...))`` rather than a
    ``row_number`` window: the aggregate is combined map-side, so a hot key
    (for example a scene delivered many times) never lands whole in one
    task.  Ties on ``order`` are broken by the remaining ``values`` columns,
    which makes the choice deterministic.
    """
    values = [c for c in (values or [c for c in df.columns if c not in keys and c not in order])]
    payload = [c for c in order] + [c for c in values if c not in order]
    # one expression text each: far fewer calls into the JVM than a Column for every field
    best = df.groupBy(*keys).agg(F.expr(f"max(struct({', '.join(f'`{c}`' for c in payload)}))").alias("_best"))
    return best.selectExpr(*[f"`{k}`" for k in keys], *[f"_best.`{c}` AS `{c}`" for c in payload])


def drop_scl(df: DataFrame, exclude=tuple(K.SCL_EXCLUDE), col: str = "scl") -> DataFrame:
    """drop observations whose scene class is in the exclusion list."""
    return df.where(~F.col(col).isin(list(exclude)))


def drop_incomplete(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """+/-inf -> null on floating columns, NaN too, then drop any null."""
    cols = cols or df.columns
    fixes = {}
    for f in df.schema.fields:
        if f.name in cols and f.dataType.typeName() in ("double", "float"):
            c = F.col(f.name)
            fixes[f.name] = F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None)).otherwise(c)
    out = df.withColumns(fixes) if fixes else df
    return out.dropna("any", subset=cols)


def quality_filter(df: DataFrame) -> DataFrame:
    """F06 + F07 on the columns an observation needs."""
    needed = [c for c in ["CDL", "scl", *K.BANDS] if c in df.columns]
    return drop_incomplete(drop_scl(df), needed)


def rejected_rows(df: DataFrame) -> DataFrame:
    """Q17: the rows ``quality_filter`` drops, each with its reason (nothing is silently lost)."""
    needed = [c for c in ["CDL", "scl", *K.BANDS] if c in df.columns]
    reason = (F.when(F.col("scl").isin(list(K.SCL_EXCLUDE)), F.concat(F.lit("scl excluded: "), F.col("scl").cast("string")))
              .when(F.col("CDL").isNull(), F.lit("class not in dictionary"))
              .when(F.greatest(*[F.col(c).isNull().cast("int") for c in needed]) == 1, F.lit("incomplete row")))
    return df.withColumn("reason", reason).where(F.col("reason").isNotNull())


def attach_class_names(pixels: DataFrame, dictionary: DataFrame, code_col: str = "code") -> DataFrame:
    """Left lookup of class name and RGB; a miss gives null name, RGB 0,0,0.

    The dictionary is keyed by an 8-bit code, so it is broadcast; its size is
    checked against that bound first.
    """
    d = dictionary.where(F.col("class_name").isNotNull()).select(
        F.col("code").alias("_code"), F.col("class_name").alias("CDL"), "r", "g", "b")
    n = d.limit(MAX_DICTIONARY_ROWS + 1).count()  # the check itself reads at most 257 rows
    if n > MAX_DICTIONARY_ROWS:
        raise ValueError(f"class dictionary has more than {MAX_DICTIONARY_ROWS} rows (8-bit codes)")
    joined = pixels.join(F.broadcast(d), pixels[code_col] == d["_code"], "left").drop("_code")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in ("r", "g", "b")})


def sample_cells(samples: DataFrame, tiles: DataFrame, cell_fn, cell_degrees: float = 0.05) -> DataFrame:
    """T06 for every tile covering a sample: the sample's (row, col) in that tile's grid.

    ``tiles`` holds one row per (year, mgrs) with the tile footprint
    (min/max lon/lat).  Footprints are exploded to the ``cell_degrees``
    grid cells they touch and samples are equi-joined on (year, cell of the
    point), then the exact point-in-footprint test runs.  Cells of 0.05 degrees
    hold some 25,000 samples of 30 m a year at most, so no key holds a whole
    area, and a tile touches some 600 of them.  A point lies in one cell, so each (sample, covering tile) pair appears once and a sample
    never meets tiles that do not cover it (no all-pairs join per year).
    """
    fl = lambda c: F.floor(F.col(c) / F.lit(cell_degrees))
    tc = (tiles.withColumn("_cx", F.explode(F.sequence(fl("min_lon"), fl("max_lon"))))
               .withColumn("_cy", F.explode(F.sequence(fl("min_lat"), fl("max_lat")))))
    s = samples.withColumns({"_cx": fl("lon"), "_cy": fl("lat")})
    inside = ((F.col("lon") >= F.col("min_lon")) & (F.col("lon") <= F.col("max_lon"))
              & (F.col("lat") >= F.col("min_lat")) & (F.col("lat") <= F.col("max_lat")))
    with_tiles = s.join(tc, ["year", "_cx", "_cy"]).where(inside).drop(
        "_cx", "_cy", "min_lon", "min_lat", "max_lon", "max_lat")
    # a generator of one row: what is asked of row and col later is not pushed below and worked out again
    return with_tiles.select("*", F.inline_outer(F.array(_row_col(cell_fn(F.col("lon"), F.col("lat"), F.col("mgrs"))))))


def _row_col(cell: Column) -> Column:
    return let(cell, lambda c: record(row=c["row"], col=c["col"]))
