"""Column contracts and value domains of the transaction tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

# ---- Fixed values: column names, anchor date, bands and domains of the public data set ----

RAW_COLUMNS = [
    "month",
    "town",
    "flat_type",
    "block",
    "street_name",
    "storey_range",
    "floor_area_sqm",
    "flat_model",
    "lease_commence_date",
    "remaining_lease",
    "resale_price",
]
KEY_COLUMNS = [
    "month",
    "town",
    "flat_type",
    "storey_range",
    "flat_model",
    "lease_commence_date",
    "floor_area_sqm",
    "resale_price",
]
PROCESSED_COLUMNS = [
    "town",
    "flat_type",
    "flat_model_revised",
    "flat_age_years",
    "floor_area_sqm",
    "days_from_earliest_data",
    "storey_range_grouped",
    "resale_price",
]
LABEL = "resale_price"
MODEL_COLUMNS = [
    "flat_age_years",
    "floor_area_sqm",
    "flat_type",
    "flat_model_revised",
    "storey_range_grouped",
    "town",
    "days_from_earliest_data",
    "resale_price",
]
DRIFT_COLUMNS = ["flat_age_years", "floor_area_sqm"]
EARLIEST_MONTH = dt.date(2012, 3, 1)
VARIANT_WORD = "Maisonette"
STOREY_EDGES = [0, 15, 30, 99]
STOREY_LABELS = ["1-15", "16-30", "31+"]

TOWNS = [
    "Ang Mo Kio", "Bedok", "Bishan", "Bukit Batok", "Bukit Merah", "Bukit Panjang", "Bukit Timah",
    "Central Area", "Choa Chu Kang", "Clementi", "Geylang", "Hougang", "Jurong East", "Jurong West",
    "Kallang/Whampoa", "Marine Parade", "Pasir Ris", "Punggol", "Queenstown", "Sembawang", "Sengkang",
    "Serangoon", "Tampines", "Toa Payoh", "Woodlands", "Yishun",
]
FLAT_TYPES = ["1 Room", "2 Room", "3 Room", "4 Room", "5 Room", "Executive", "Multi-Generation"]
FLAT_MODELS = [
    "2-Room", "3gen", "Adjoined Flat", "Apartment", "Dbss", "Improved", "Maisonette", "Model A", "Model A2",
    "Multi Generation", "New Generation", "Premium Apartment", "Premium Apartment Loft", "Simplified",
    "Standard", "Terrace", "Type S1", "Type S2",
]

# Texts a CSV reader with the usual data-frame defaults takes for "missing".
MISSING_MARKERS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# ---- End of fixed values ----

DOMAINS = {
    "town": TOWNS,
    "flat_type": FLAT_TYPES,
    "flat_model_revised": FLAT_MODELS,
    "storey_range_grouped": STOREY_LABELS,
}


def text_schema(columns: list[str]) -> T.StructType:
    """All columns as nullable text, in the given order."""
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


RAW = text_schema(RAW_COLUMNS)

SCORING = T.StructType(
    [
        T.StructField("flat_age_years", T.LongType()),
        T.StructField("floor_area_sqm", T.DoubleType()),
        T.StructField("days_from_earliest_data", T.LongType()),
        T.StructField("flat_type", T.StringType()),
        T.StructField("flat_model_revised", T.StringType()),
        T.StructField("town", T.StringType()),
        T.StructField("storey_range_grouped", T.StringType()),
    ]
)

_PROCESSED_TYPES = {field.name: field.dataType for field in SCORING} | {LABEL: T.DoubleType()}
PROCESSED = T.StructType([T.StructField(name, _PROCESSED_TYPES[name]) for name in PROCESSED_COLUMNS])
