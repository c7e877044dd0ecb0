"""Fixed schemas, feature lists and segment maps — owned by this one module.

Every list here is positional: feature vectors are assembled in exactly this
order, so the order must not change.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the original application's for matching results)
# ---------------------------------------------------------------------------

# Master table columns, in loader order.
MASTER_COLUMNS = [
    "Name", "Age", "Overall rating", "Potential", "Team", "ID", "Value", "Wage",
    "Total attacking", "Total skill", "Total movement", "Total power",
    "Total mentality", "Total defending", "Total goalkeeping",
    "Pace / Diving", "Shooting / Handling", "Passing / Kicking",
    "Dribbling / Reflexes", "Defending / Pace", "Position category",
]

# Message (and scraper) column order.
MESSAGE_COLUMNS = [
    "Name", "ID", "Age", "Overall rating", "Potential", "Team", "Position category",
    "Value", "Wage", "Total attacking", "Total skill", "Total movement", "Total power",
    "Total mentality", "Total defending", "Total goalkeeping", "Pace / Diving",
    "Shooting / Handling", "Passing / Kicking", "Dribbling / Reflexes", "Defending / Pace",
]

STRING_COLUMNS = ["Name", "Team", "ID", "Position category"]
MONEY_COLUMNS = ["Value", "Wage"]

# The 17 numeric columns of the master table.
NUMERIC_COLUMNS = [
    "Age", "Overall rating", "Potential", "Value", "Wage", "Total attacking",
    "Total skill", "Total movement", "Total power", "Total mentality",
    "Total defending", "Total goalkeeping", "Pace / Diving",
    "Shooting / Handling", "Passing / Kicking", "Dribbling / Reflexes",
    "Defending / Pace",
]

# The seven totals rescaled to 1..99.
TOTAL_COLUMNS = [
    "Total attacking", "Total skill", "Total movement", "Total power",
    "Total mentality", "Total defending", "Total goalkeeping",
]

STAT_COLUMNS = [
    "Pace / Diving", "Shooting / Handling", "Passing / Kicking",
    "Dribbling / Reflexes", "Defending / Pace",
]

SHARED_FEATURES = ["Age", "Overall rating", "Potential", "Wage"]
GOALKEEPER_FEATURES = SHARED_FEATURES + [
    "Total goalkeeping", "Pace / Diving", "Shooting / Handling",
    "Passing / Kicking", "Dribbling / Reflexes",
]
FIELD_FEATURES = SHARED_FEATURES + [
    "Total attacking", "Total skill", "Total movement", "Total power",
    "Total mentality", "Total defending",
]

# Category -> index; anything else (including null -> "unknown") is 4.
CATEGORY_INDEX = [("attaquant", 0), ("milieu", 1), ("défenseur", 2), ("gardien", 3)]
OTHER_CATEGORY_INDEX = 4
UNKNOWN_CATEGORY = "unknown"

# Position code -> category.
POSITION_GROUPS = [
    ("gardien", ["GK"]),
    ("attaquant", ["CF", "ST", "RW", "LW"]),
    ("défenseur", ["CB", "LB", "RB", "RWB", "LWB"]),
    ("milieu", ["CM", "CDM", "CAM", "LM", "RM"]),
]

# Model segments: goalkeeper = index 3, field = indexes 0, 1, 2; index 4 is in neither.
GOALKEEPER_INDEXES = [3]
FIELD_INDEXES = [0, 1, 2]
SEGMENTS = {"goalkeeper": GOALKEEPER_FEATURES, "field": FIELD_FEATURES}

# Outlier band width in sample standard deviations of log1p(Value).
TRIM_SIGMAS = {"goalkeeper": 3.0, "field": 2.5, "feed": 3.0}
VALUE_CAP = 1.7e8

# Notebook report column sets.
CORRELATION_COLUMNS = [
    "Age", "Overall rating", "Potential", "Value", "Wage", "Total attacking",
    "Total skill", "Total movement", "Total power", "Total mentality",
    "Total defending", "Total goalkeeping",
]
PAIR_COLUMNS = ["Age", "Overall rating", "Potential", "Value", "Wage"]
COMPARISON_CATEGORIES = ["Overall rating", "Potential", "Total attacking", "Total skill", "Total movement"]
REPORT_REQUIRED = ["Value", "Wage", "Age", "Team"]

# What-if request validation: (field, low, high); required fields default to 0,
# the others to 1 when missing.
REQUIRED_RANGES = [("Age", 15, 40), ("Overall rating", 50, 99), ("Potential", 50, 99), ("Wage", 0, 200000)]
OTHER_RANGE = (1, 99)

# Listing table cell indexes (first <table>, rows with at least 66 <td>).
MIN_CELLS = 66
CELL_NAME, CELL_AGE, CELL_OVERALL, CELL_POTENTIAL, CELL_TEAM, CELL_ID = 1, 2, 3, 4, 5, 6
CELL_POSITION, CELL_CONTRACT, CELL_VALUE, CELL_WAGE = 11, 12, 13, 14
TOTAL_CELLS = [16, 22, 28, 34, 40, 47, 51]          # in TOTAL_COLUMNS order
STAT_CELLS = [60, 61, 62, 63, 64]                    # in STAT_COLUMNS order
PAGE_ROWS = 60                                       # rows per listing page offset step

# Model kinds and grids.
MODEL_KINDS = ["forest", "linear", "forest_sub", "elastic"]
CV_FOLDS = {"goalkeeper": 3, "field": 2}
SPLIT_SEED = 42
TRAIN_FRACTION_PERCENT = 80

# Inverse transforms.
CALIBRATION_FACTOR_REFERENCE = 3.418825e7 / 3441558.4048566045
WHATIF_SCALE = 1000 * 0.005

# ---------------------------------------------------------------------------


def _field(name: str) -> T.StructField:
    if name in STRING_COLUMNS:
        return T.StructField(name, T.StringType(), True)
    if name in MONEY_COLUMNS:
        return T.StructField(name, T.DoubleType(), True)
    return T.StructField(name, T.IntegerType(), True)


MASTER_SCHEMA = T.StructType([_field(c) for c in MASTER_COLUMNS])
MESSAGE_SCHEMA = T.StructType([_field(c) for c in MESSAGE_COLUMNS])

ENVELOPE_SCHEMA = T.StructType([
    T.StructField("key", T.StringType(), True),
    T.StructField("value", T.StringType(), True),
    T.StructField("topic", T.StringType(), True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("offset", T.LongType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
])


def segment_features(segment: str) -> list[str]:
    return SEGMENTS[segment]


def sql_ident(name: str) -> str:
    """Backtick-quote a column name for Spark SQL / double-quote for DuckDB."""
    return "`" + name.replace("`", "``") + "`"
