"""Fixed values of the crop-type data model.

Everything in the block marked FIXED VALUES must equal the values the
original workflow uses, otherwise labels, band positions, normalisation
and sweep results change. They are listed plainly, in their natural order.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES (semantics of the data model; do not reorder)
# ---------------------------------------------------------------------------

# Scene assets in acquisition order: quality layer first, then 12 bands.
ASSETS = [
    "scl", "coastal", "blue", "green", "red", "rededge1", "rededge2",
    "rededge3", "nir", "nir08", "nir09", "swir16", "swir22",
]
# The 12 spectral bands in packed-series order (red = index 3, nir = index 7).
BANDS = [
    "coastal", "blue", "green", "red", "rededge1", "rededge2", "rededge3",
    "nir", "nir08", "nir09", "swir16", "swir22",
]
RED_INDEX = 3
NIR_INDEX = 7

# Scene classification (SCL) codes that are dropped from observations.
SCL_EXCLUDE = [0, 1, 7, 8, 9, 11]
SCL_NAMES = {
    0: "No Data",
    1: "Saturated or defective pixel",
    2: "Topographic casted shadows",
    3: "Cloud shadows",
    4: "Vegetation",
    5: "Not-vegetated",
    6: "Water",
    7: "Unclassified",
    8: "Cloud medium probability",
    9: "Cloud high probability",
    10: "Thin cirrus",
    11: "Snow or ice",
}
SCL_VEGETATION = 4

# Scene usable-area rule: sum of these five percentages must be > 30.
USABLE_AREA_PROPERTIES = [
    "vegetation_percentage",
    "not_vegetated_percentage",
    "thin_cirrus_percentage",
    "cloud_shadow_percentage",
    "dark_features_percentage",
]
USABLE_AREA_THRESHOLD = 30.0

# Classes the model predicts directly (labels 3..6 in this order).
TARGET_CROPS = ["Soybeans", "Rice", "Corn", "Cotton"]
# Classes grouped as "Cultivated" (label 1).
OTHER_CULTIVATED = [
    "Other Hay/Non Alfalfa", "Pop or Orn Corn", "Peanuts", "Sorghum", "Oats",
    "Peaches", "Clover/Wildflowers", "Pecans", "Sod/Grass Seed", "Other Crops",
    "Dry Beans", "Winter Wheat", "Alfalfa", "Potatoes", "Peas", "Herbs", "Rye",
    "Cantaloupes", "Sunflower", "Watermelons", "Sweet Corn", "Sweet Potatoes",
]
LABEL_LEGEND = [
    "Uncultivated", "Cultivated", "No Crop Growing", "Soybeans", "Rice",
    "Corn", "Cotton",
]
NUM_CLASSES = len(LABEL_LEGEND)
LABEL_NO_CROP_GROWING = 2

# Loader geometry.
BATCH_SIZE = 1028
MAX_EPOCHS = 40
DAYS_IN_SERIES = 120
DAYS_PER_BUCKET = 5
MAX_IMAGES_PER_SERIES = DAYS_IN_SERIES // DAYS_PER_BUCKET + 1  # 25 slots
MAX_NORMALISED_DAY = 365

# Per-band normalisation of the training split (12 bands, band order above).
BAND_MEANS = [
    608.8101, 696.796, 960.03357, 987.1987, 1450.7101, 2489.7905,
    2950.8835, 3028.4963, 3187.6309, 3306.6196, 2559.1113, 1759.3562,
]
BAND_STDS = [
    434.22964, 462.67017, 522.5876, 707.9728, 700.35565, 959.60223,
    1269.392, 1238.029, 1319.5139, 1398.4331, 1125.598, 1127.1315,
]

# Start days of the prediction sweep (the last step is 5, not 15).
SWEEP_START_DAYS = [0, 15, 30, 45, 60, 75, 90, 105, 120, 135, 150, 165, 180, 195, 200]

# Areas of interest (EPSG:5070 metres, "left, bottom, right, top") and years.
AOI_BBOXES = [
    "426362, 1405686, 520508, 1432630",
    "390747, 1195097, 437820, 1284288",
    "465073, 1479393, 583994, 1504168",
    "549309, 1536066, 592356, 1571061",
    "491706, 1510362, 571916, 1531111",
    "434104, 1306585, 498520, 1342509",
    "414748, 1149262, 439833, 1193858",
]
AOI_YEARS = [2019, 2020, 2021]
DENSE_TEST_BBOX = "484932, 1401912, 489035, 1405125"
DENSE_TEST_YEAR = 2019

# Spatial sampling strides: default, writer default, train/validation, dense test.
STRIDE_DEFAULT = 3
STRIDE_WRITER = 10
STRIDE_TRAIN = 15
STRIDE_DENSE = 1

# Codec value ranges: bands and dates are unsigned 16-bit, SCL unsigned 8-bit.
U16_MAX = 65535
U8_MAX = 255
EPOCH = "1970-01-01"

# Projection parameters of EPSG:5070 (CONUS Albers, GRS80) and EPSG:3857.
GRS80_A = 6378137.0
GRS80_INV_F = 298.257222101
WGS84_A = 6378137.0
WGS84_INV_F = 298.257223563
ALBERS_LAT1 = 29.5
ALBERS_LAT2 = 45.5
ALBERS_LAT0 = 23.0
ALBERS_LON0 = -96.0
UTM_K0 = 0.9996
UTM_FALSE_EASTING = 500000.0
UTM_FALSE_NORTHING_SOUTH = 10000000.0
WEB_MERCATOR_R = 6378137.0

# ---------------------------------------------------------------------------
# end of fixed values
# ---------------------------------------------------------------------------

# Splits used by the fixture data derived from the driver's tables
# (the original uses train 2021, validation 2020, test 2019; the fixture
# years run 1995-2001, so the same train > validation > test order is kept).
FIXTURE_SPLIT_YEARS = {"train": 2000, "validation": 1999, "test": 1998}
