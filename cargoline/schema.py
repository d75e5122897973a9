"""Fixed values of the delivery data model.

Everything in this module must equal the values the original job uses,
otherwise results differ: the input schema, the delivery-type codes, the
box factor, the standard unit label, the country codes, the Spanish to
English column names and the output column order.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DecimalType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# --- fixed values (must match the original job) ---------------------------

# Input file layout: nine nullable fields, bound by position.
DELIVERY_SCHEMA = StructType(
    [
        StructField("pais", StringType(), True),
        StructField("fecha_proceso", StringType(), True),
        StructField("transporte", StringType(), True),
        StructField("ruta", StringType(), True),
        StructField("tipo_entrega", StringType(), True),
        StructField("material", StringType(), True),
        StructField("precio", DecimalType(38, 18), True),
        StructField("cantidad", DecimalType(38, 18), True),
        StructField("unidad", StringType(), True),
    ]
)

ROUTINE_TYPES = ("ZPRE", "ZVE1")
BONUS_TYPES = ("Z04", "Z05")
BOX_FACTOR = 20
BOX_UNIT = "CS"
STANDARD_UNIT = "ST"
COUNTRY_CODES = ("GT", "PE", "EC", "SV", "HN", "JM")
PROCESS_DATE_FORMAT = "yyyyMMdd"
QUOTED_EMPTY = '""'
FLAG_VALID = "VALID"
FLAG_REVIEW = "REVIEW"

RENAME_TO_STANDARD = {
    "pais": "country_code",
    "fecha_proceso": "process_date",
    "transporte": "transport_id",
    "ruta": "route_id",
    "tipo_entrega": "delivery_type",
    "material": "material_code",
    "precio": "price",
    "cantidad": "quantity_original",
    "unidad": "unit_original",
}

FINAL_COLUMNS = (
    "country_code",
    "process_date",
    "transport_id",
    "route_id",
    "material_code",
    "delivery_type",
    "is_routine_delivery",
    "is_bonus_delivery",
    "quantity_original",
    "unit_original",
    "quantity_standardized",
    "unit_standardized",
    "price",
    "unit_price",
    "total_value",
    "data_quality_flag",
    "processing_timestamp",
)

# --- derived ----------------------------------------------------------------

RAW_COLUMNS = tuple(f.name for f in DELIVERY_SCHEMA.fields)
MONEY = DecimalType(38, 6)
RAW_DECIMAL = DecimalType(38, 18)

# Read-back schema of the standard output: process_date stays text even when
# it comes back as a hive partition column.
OUTPUT_SCHEMA = StructType(
    [
        StructField("country_code", StringType(), True),
        StructField("process_date", StringType(), True),
        StructField("transport_id", StringType(), True),
        StructField("route_id", StringType(), True),
        StructField("material_code", StringType(), True),
        StructField("delivery_type", StringType(), True),
        StructField("is_routine_delivery", BooleanType(), True),
        StructField("is_bonus_delivery", BooleanType(), True),
        StructField("quantity_original", RAW_DECIMAL, True),
        StructField("unit_original", StringType(), True),
        StructField("quantity_standardized", MONEY, True),
        StructField("unit_standardized", StringType(), True),
        StructField("price", RAW_DECIMAL, True),
        StructField("unit_price", MONEY, True),
        StructField("total_value", MONEY, True),
        StructField("data_quality_flag", StringType(), True),
        StructField("processing_timestamp", TimestampType(), True),
    ]
)
