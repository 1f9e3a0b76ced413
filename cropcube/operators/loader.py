"""Series -> fixed 25-slot training examples (F09, F16, F18, F19, J06, J07, L08-L10,
M06, M07, S15, T26-T32, T39-T41, W04-W10, A08, A09).

Everything after series assembly is a per-row expression over the image
array (higher-order functions): no shuffle, no Python.  Random draws of the
original (window start, 25-image subsample, shuffle) are seeded MD5 draws of
the series key, so results are reproducible and identical in any engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropcube import constants as K
from cropcube.functions.draws import draw
from cropcube.functions.hof import let, record
from cropcube.functions.labels import crop_label, is_double_crop, one_hot
from cropcube.operators.series import series_rows

SLOT_TYPE = "struct<slot:int,bands:array<int>,ndvi:int,scl:int,day:int>"


def start_draw(key, seed: int = 0, epoch: int = 0) -> Column:
    """Draw of a series for its window start; another epoch gives another window."""
    return draw("start", *[F.col(k) for k in key], seed=seed, epoch=epoch)


def image_draw(key, row, seed: int = 0, epoch: int = 0) -> Column:
    """Draw of an image of a series (day and tile name it) for the subsample."""
    return draw("image", *[F.col(k) for k in key], row["day"], row["tile"], seed=seed, epoch=epoch)


def random_start(rows: Column, start: Column, days: int = K.DAYS_IN_SERIES) -> Column:
    """Start day uniform in [0, max(1, last_day - days)) from a draw."""
    last_day = F.element_at(rows, -1)["day"]
    return (start % F.greatest(F.lit(1), last_day - F.lit(days))).cast("int")


def day_window(rows: Column, start: Column, days: int = K.DAYS_IN_SERIES) -> Column:
    """images whose day lies in the closed window [start, start + days]."""
    return F.filter(rows, lambda r: (r["day"] >= start) & (r["day"] <= start + F.lit(days)))


def subsample(rows: Column, key, max_images: int = K.MAX_IMAGES_PER_SERIES, seed: int = 0, epoch: int = 0) -> Column:
    """At most ``max_images`` images in the order of their draws, back in date order."""
    def body(rs):
        keyed = F.array_sort(F.transform(rs, lambda r: record(
            k=image_draw(key, r, seed, epoch), d=r["day"], t=r["tile"], r=r)))
        chosen = F.transform(F.slice(keyed, 1, max_images), lambda x: record(d=x["d"], t=x["t"], r=x["r"]))
        back = F.transform(F.array_sort(chosen), lambda x: x["r"])
        return F.when(F.size(rs) <= max_images, rs).otherwise(back)
    return let(rows, body)


def bucketize(rows: Column, days_per_bucket: int = K.DAYS_PER_BUCKET) -> Column:
    """W06 + W09 + W04 + T41 + T28: day-sorted images -> filled slots.

    Days are re-based on the first kept image and clipped to [0, 365];
    slot = day div 5; the first image of each slot wins; an empty window
    gives one all-zero row in slot 0.
    """
    zero = F.array(record(slot=F.lit(0), bands=F.array_repeat(F.lit(0), len(K.BANDS)),
                          ndvi=F.lit(0), scl=F.lit(0), day=F.lit(0)))

    def slotted_of(rs):
        return F.transform(rs, lambda r: let(
            F.least(F.lit(K.MAX_NORMALISED_DAY), F.greatest(F.lit(0), r["day"] - rs[0]["day"])),
            lambda nd: record(slot=(nd / F.lit(days_per_bucket)).cast("int"),
                              bands=r["bands"], ndvi=r["ndvi"], scl=r["scl"], day=nd)))

    def firsts(sl):
        return F.filter(sl, lambda s, i: (i == 0) | (s["slot"] != F.element_at(sl, F.greatest(i, F.lit(1)))["slot"]))

    return let(rows, lambda rs: F.when(F.size(rs) == 0, zero).otherwise(let(slotted_of(rs), firsts)))


def label_of(cdl: Column, slots: Column) -> Column:
    """T29 on the bucketed series (SCL of the slots in slot order)."""
    return crop_label(cdl, F.transform(slots, lambda s: s["scl"]))


def training_examples(series: DataFrame, key=("bbox", "year", "pixel_id", "CDL"),
                      max_images: int | None = K.MAX_IMAGES_PER_SERIES,
                      drop_double_crops: bool = True, seed: int = 0, epoch: int = 0) -> DataFrame:
    """Train/validation loader: random window, subsample, bucket, label.

    Each ``epoch`` redraws windows and images; the same seed and epoch repeat them.
    Output: key..., start_day, slots array<slot struct>, label.
    """
    df = series
    if drop_double_crops:
        df = df.where(~is_double_crop(F.col("CDL")))
    rows = series_rows("images")
    df = df.select(*key, rows.alias("_rows")) \
        .withColumn("start_day", random_start(F.col("_rows"), start_draw(key, seed, epoch)))
    win = day_window(F.col("_rows"), F.col("start_day"))
    if max_images is not None:
        win = subsample(win, key, max_images, seed, epoch)
    df = df.withColumn("slots", bucketize(win))
    return df.select(*key, "start_day", "slots", label_of(F.col("CDL"), F.col("slots")).alias("label"))


def sweep_examples(series: DataFrame, key=("bbox", "year", "pixel_id", "CDL"),
                   start_days=tuple(K.SWEEP_START_DAYS), max_images: int | None = None,
                   seed: int = 0, epoch: int = 0) -> DataFrame:
    """J07 + W10: every series x every sweep start day in one pass.

    The slots of all start days are computed from the one row that holds the images, and
    only then expanded: each output row carries its own slots, never the image array.
    Double crops are kept, as in the test loader.
    """
    rows = series_rows("images")

    def slots_from(rs, start):
        win = day_window(rs, start)
        return bucketize(win if max_images is None else subsample(win, key, max_images, seed, epoch))

    days = F.array(*[F.lit(int(d)) for d in start_days])
    starts = let(rows, lambda rs: F.transform(days, lambda d: record(start_day=d, slots=slots_from(rs, d))))
    df = series.select(*key, F.inline_outer(starts))
    return df.select(*key, "start_day", "slots", label_of(F.col("CDL"), F.col("slots")).alias("label"))


def slots_long(examples: DataFrame, key=("bbox", "year", "pixel_id", "CDL", "start_day"), extra=("label",)) -> DataFrame:
    """One row per filled slot with the 15 feature columns.

    ``bucketize`` leaves no example without slots, so nothing is filtered here: a filter
    above the slots' expression would make the optimiser work out all that holds for it.
    """
    return examples.select(*key, *extra, F.explode_outer("slots").alias("s")).select(
        *key, *extra, F.col("s.slot").alias("slot"), F.col("s.day").alias("day"),
        F.col("s.ndvi").alias("ndvi"), F.col("s.scl").alias("scl"),
        *[F.col("s.bands")[i].alias(b) for i, b in enumerate(K.BANDS)])


def slot_count(days: int = K.DAYS_IN_SERIES, days_per_bucket: int = K.DAYS_PER_BUCKET) -> int:
    """Slots of a closed window of ``days``: 25 for 120 days in buckets of 5."""
    return min(days, K.MAX_NORMALISED_DAY) // days_per_bucket + 1


def dense_slots(slots: Column, days: int = K.DAYS_IN_SERIES, days_per_bucket: int = K.DAYS_PER_BUCKET) -> Column:
    """One row for each slot of the window x 15 ints (12 bands, ndvi, scl, day), zero padded."""
    by_slot = F.map_from_entries(F.transform(slots, lambda s: record(k=s["slot"], v=s)))
    places = F.sequence(F.lit(0), F.lit(slot_count(days, days_per_bucket) - 1))
    zero = F.array_repeat(F.lit(0), len(K.BANDS) + 3)

    def row(s):
        return F.when(s.isNull(), zero).otherwise(F.concat(s["bands"], F.array(s["ndvi"], s["scl"], s["day"])))
    # bound once: an expression in a lambda is worked out again for each element and each use of it
    return let(by_slot, lambda m: F.transform(places, lambda i: let(F.try_element_at(m, i), row)))


def normalise_bands(bands: Column, means=tuple(K.BAND_MEANS), stds=tuple(K.BAND_STDS)) -> Column:
    """Z-score per band, zero (padding) stays zero."""
    m = F.array(*[F.lit(float(v)) for v in means])
    s = F.array(*[F.lit(float(v)) for v in stds])
    return F.transform(bands, lambda v, i: F.when(v == 0, F.lit(0.0)).otherwise((v.cast("double") - m[i]) / s[i]))


def features(slots: Column, means=None, stds=None, days: int = K.DAYS_IN_SERIES) -> Column:
    """F16 + T27 + T31 + T32: flattened slots x 12 normalised band features (300 doubles for 120 days)."""
    dense = dense_slots(slots, days)
    bands = F.transform(dense, lambda r: F.slice(r, 1, len(K.BANDS)))
    normed = F.transform(bands, lambda b: normalise_bands(b, means or K.BAND_MEANS, stds or K.BAND_STDS))
    return F.flatten(normed)


def with_one_hot(examples: DataFrame, label_col: str = "label") -> DataFrame:
    """One-hot label vector."""
    return examples.withColumn("label_one_hot", one_hot(F.col(label_col)))


def fit_normaliser(long_slots: DataFrame) -> DataFrame:
    """M06 (A08 + A09): per band mean and population std over non-zero values.

    One aggregate pass with partial aggregation; the result is one row per
    band (12 rows).  Zeros are masked per column.
    """
    stacked = long_slots.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("band_index"), F.lit(b).alias("band"), F.col(b).alias("v"))
        for i, b in enumerate(K.BANDS)])).alias("s")).select("s.*")
    nz = F.when(F.col("v") != 0, F.col("v").cast("double"))
    return stacked.groupBy("band_index", "band").agg(F.avg(nz).alias("mean"), F.stddev_pop(nz).alias("std"))


def split_by_year(series: DataFrame, years: dict[str, int]) -> dict[str, DataFrame]:
    """S12 + M07: one DataFrame per split, each a partition filter on year."""
    return {name: series.where(F.col("year") == F.lit(int(y))) for name, y in years.items()}


def split_keys(series: DataFrame, years: dict[str, int], key=("pixel_id", "year")) -> DataFrame:
    """The split and key of every series of the split years, from one scan."""
    split = F.coalesce(*[F.when(F.col("year") == F.lit(int(y)), F.lit(n)) for n, y in years.items()])
    return series.select(split.alias("split"), *key).where(F.col("split").isNotNull()).distinct()


def leakage(keys: DataFrame, key=("pixel_id",)) -> DataFrame:
    """M07 check: keys that occur in more than one split, with these splits.

    ``keys`` has ``split`` and the key columns; one aggregation, at most one entry a split.
    """
    return keys.groupBy(*key).agg(F.sort_array(F.collect_set("split")).alias("splits")).where(F.size("splits") > 1)
