"""Names, lengths, grids and formats that results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

ROW_ID = "application_id"

# Source header -> canonical column.
RENAMES = {
    "Age": "age",
    "Sex": "sex",
    "Job": "job",
    "Housing": "housing",
    "Saving accounts": "saving_accounts",
    "Checking account": "checking_account",
    "Credit amount": "credit_amount",
    "Duration": "duration",
    "Purpose": "purpose",
    "Risk": "risk",
    "Age_cat": "age_cat",
}

# Canonical column -> warehouse column, in load order.
WAREHOUSE_NAMES = {
    "age": "age",
    "sex": "sex",
    "job": "job",
    "housing": "housing",
    "saving_accounts": "saving_account",
    "checking_account": "check_account",
    "duration": "duration",
    "purpose": "purpose",
}

# Longest text the warehouse accepts.
TEXT_LENGTHS = {
    "sex": 8,
    "housing": 6,
    "saving_accounts": 20,
    "checking_account": 20,
    "purpose": 40,
}

# Fixed value: what stands for a missing category.
MISSING = "no_inf"

# Column -> prefix of its indicator columns.
PREFIXES = {
    "purpose": "Purpose",
    "sex": "Sex",
    "housing": "Housing",
    "saving_accounts": "Savings",
    "risk": "Risk",
    "checking_account": "Check",
    "age_cat": "Age_cat",
}
TARGET = "Risk_bad"
TARGET_COMPLEMENT = "Risk_good"
TARGET_LEVEL = "bad"

# Own choice: right-closed age bands.
AGE_EDGES = [18, 25, 35, 60, 120]
AGE_LABELS = ["Student", "Young", "Adult", "Senior"]

APPLICATION_SCHEMA = T.StructType(
    [
        T.StructField("application_id", T.LongType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("sex", T.StringType()),
        T.StructField("job", T.IntegerType()),
        T.StructField("housing", T.StringType()),
        T.StructField("saving_accounts", T.StringType()),
        T.StructField("checking_account", T.StringType()),
        T.StructField("credit_amount", T.DoubleType()),
        T.StructField("duration", T.IntegerType()),
        T.StructField("purpose", T.StringType()),
        T.StructField("risk", T.StringType()),
    ]
)

LINEAGE_SCHEMA = T.StructType(
    [
        T.StructField("batch_nr", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("step", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("destination", T.StringType()),
    ]
)

# Warehouse tables as (column, SQL type).
WAREHOUSE_TABLES = {
    "card_data": [
        ("age", "INT"),
        ("sex", "STRING"),
        ("job", "INT"),
        ("housing", "STRING"),
        ("saving_account", "STRING"),
        ("check_account", "STRING"),
        ("duration", "INT"),
        ("purpose", "STRING"),
    ],
    "data_flow": [
        ("batch_nr", "BIGINT"),
        ("timestamp", "TIMESTAMP"),
        ("step", "STRING"),
        ("source", "STRING"),
        ("destination", "STRING"),
    ],
}

TIME_ZONE = "America/Mazatlan"

# Seed and share of the split, and numbers of folds.
SPLIT_SEED = 42
TEST_SHARE = 0.25
KFOLDS = 10
STRATIFIED_FOLDS = 5

# Random-forest grid; None stands for "as deep as possible".
FOREST_GRID = {
    "max_depth": [3, 5, 7, 10, None],
    "n_estimators": [3, 5, 10, 25, 50, 150],
    "max_features": [4, 7, 15, 20],
}

# Boosted-tree grid.
BOOSTED_GRID = {
    "max_depth": [3, 5, 6, 10],
    "min_child_weight": [3, 5, 10],
    "gamma": [0.0, 0.1, 0.2, 0.3, 0.4],
    "subsample": [0.75, 0.80, 0.85],
    "colsample_bytree": [0.75, 0.80, 0.85],
}

# The forest that is fitted without a search.
FIXED_FOREST = {"max_depth": None, "max_features": 10, "n_estimators": 15, "seed": 2}

DEEPEST_TREE = 30
