"""Default dimension values. Every operator takes them as arguments."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# --- Fixed values: price limits, product -> (lowest, highest) -------------------------
PRICE_LIMITS = {
    2: (46.55, 97.0),
    3: (40.05, 97.0),
    4: (50.5, 97.0),
    41: (50.5, 97.0),
    42: (33.0, 85.0),
    133: (45.1, 70.0),
    139: (40.1, 95.0),
    156: (45.1, 60.0),
    173: (50.5, 97.0),
    174: (46.55, 97.0),
    175: (40.5, 97.0),
    176: (46.0, 110.0),
    177: (46.0, 110.0),
    178: (10.0, 40.0),
    179: (11.0, 45.0),
    181: (46.1, 110.0),
    182: (46.1, 110.0),
    183: (46.1, 110.0),
    184: (46.0, 110.0),
    189: (45.1, 75.0),
    204: (45.1, 70.0),
    308: (25.0, 50.0),
    332: (20.0, 80.0),
}
DEFAULT_LIMIT = (35.0, 110.0)
GLOBAL_BOUNDS = (11.0, 110.0)
MAX_ERROR_SHARE = 0.3

# --- Fixed values: products that are the same fuel under another name ------------------
EQUIVALENT_PRODUCTS = (
    (2, 174),
    (3, 175),
    (4, 41, 173),
    (176, 177, 181, 182, 183, 204),
)
DIESEL_PRODUCTS = (176, 181, 182, 183, 184)

# --- Fixed values: price sources -------------------------------------------------------
TRUSTED_SOURCES = (
    "api_azsgo",
    "api_azsopti",
    "api_benzuber",
    "api_gpn",
    "api_licard",
    "api_lukoil",
    "api_sng",
    "api_yandex_fuel",
    "api_yandex_other",
    "manual_app",
    "manual_gazprom",
    "manual_manual",
    "manual_ppr",
)
UNTRUSTED_SOURCES = (
    "api_fuelup",
    "api_ppr",
    "api_rncard",
    "manual_other",
    "manual_phone",
)
SOURCE_RANK = {
    "api_gpn": 1,
    "api_azsopti": 2,
    "api_benzuber": 3,
    "api_yandex_fuel": 4,
    "api_licard": 5,
    "api_lukoil": 6,
    "api_sng": 7,
    "api_rncard": 10,
    "api_fuelup": 11,
    "api_ppr": 12,
    "manual_manual": 13,
    "manual_app": 14,
    "manual_phone": 15,
    "manual_ppr": 16,
    "manual_gazprom": 17,
    "manual_other": 18,
    "api_yandex_other": 19,
}
REPLACEABLE_SOURCES = ("api_fuelup", "api_ppr", "api_rncard", "api_yandex_other")
REPLACING_SOURCES = (
    "api_azsgo",
    "api_azsopti",
    "api_benzuber",
    "api_gpn",
    "api_licard",
    "api_lukoil",
    "api_sng",
    "api_yandex_fuel",
)

# --- Fixed values: competitor price sources; class 0 manual, 1 automatic, 2 other ------
AUTOMATIC_SOURCES = (
    "api_azsgo",
    "api_azsopti",
    "api_benzuber",
    "api_licard",
    "api_yandex_fuel",
)
OTHER_SOURCES = ("api_ppr", "api_rncard", "api_yandex_other")
MANUAL_SOURCES = (
    "manual_app",
    "manual_gazprom",
    "manual_gpn",
    "manual_manual",
    "manual_other",
    "manual_phone",
    "manual_ppr",
)
COMPETITOR_SOURCES = AUTOMATIC_SOURCES + OTHER_SOURCES + MANUAL_SOURCES

# --- Fixed values: stations and customers ----------------------------------------------
ACTIVE_STATUSES = ("Действующая", "Реконструкция", "Ведомственная")
CUSTOMER_STATUSES = ("client", "demo", "trial")
STATION_CLASS = {
    "АЗС": 1,
    "АЗК": 1,
    "АГЗС": 2,
    "АГНКС": 2,
    "МАГЗС": 2,
    "КриоАЗС": 2,
    "МАЗК": 3,
    "МАЗС": 3,
}
COMPATIBLE_CLASSES = ((1, 1), (1, 3), (2, 2), (2, 3), (3, 1), (3, 2), (3, 3))
MAX_REGION = 86
NO_SIDE = "Нет_данных"
KM_SUFFIX = " км, "
EARTH_RADIUS_KM = 6371.0

# --- Fixed values: company registry codes ----------------------------------------------
LEGAL_FORMS = {"LEGAL": "ЮЛ", "INDIVIDUAL": "ИП"}
COMPANY_STATUSES = {
    "ACTIVE": "действующая",
    "LIQUIDATING": "ликвидируется",
    "LIQUIDATED": "ликвидирована",
    "BANKRUPT": "банкротство",
    "REORGANIZING": "В процессе присоединения",
}

# --- Fixed values: days ----------------------------------------------------------------
SHOWN_DAYS = 60
HIDDEN_DAYS = 21
TRUSTED_EXPIRY_DAYS = 6
UNTRUSTED_EXPIRY_DAYS = 16
UNTRUSTED_WINDOW_DAYS = 14
IN_REPORT_WINDOW_DAYS = 7
EQUIVALENT_PRICE_DAYS = 16
UPDATED_BY_ID = 1


BROADCAST_ROWS = 100_000  # a fixed dimension up to this many rows is sent to every task


def limits_frame(spark: SparkSession, limits: Mapping[int, tuple[float, float]]) -> DataFrame:
    """Limits as a relation whose size the planner knows."""
    if not limits:
        return spark.sql("SELECT 0L AS product_id, 0D AS lo, 0D AS hi WHERE false")
    rows = ", ".join(f"({int(p)}L, {float(lo)!r}D, {float(hi)!r}D)" for p, (lo, hi) in limits.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(product_id, lo, hi)")
