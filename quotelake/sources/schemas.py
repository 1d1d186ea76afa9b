"""Column lists of the raw tables and of the landed files."""

from __future__ import annotations

from pyspark.sql import types as T

LEVELS = (5, 10, 15, 20, 25, 30)
EUR_COLUMNS = ("open_eur", "high_eur", "low_eur", "close_eur")
PRICE_COLUMNS = ("open", "high", "low", "close")


def _fields(*pairs: tuple[str, T.DataType]) -> list[T.StructField]:
    return [T.StructField(name, kind) for name, kind in pairs]


_LONG, _DOUBLE, _TEXT = T.LongType(), T.DoubleType(), T.StringType()
_DATE, _STAMP = T.DateType(), T.TimestampNTZType()

SYMBOL_FILE = T.StructType(
    _fields(
        ("isin", _TEXT),
        ("ticker", _TEXT),
        ("name", _TEXT),
        ("asset_type", _TEXT),
        ("exchange", _TEXT),
        ("currency", _TEXT),
    )
)

SYMBOLS = T.StructType(
    _fields(("id", _LONG))
    + SYMBOL_FILE.fields
    + _fields(("created_at", _STAMP), ("is_active", T.BooleanType()))
)

CURRENCY_RATES = T.StructType(
    _fields(
        ("id", _LONG),
        ("from_currency", _TEXT),
        ("to_currency", _TEXT),
        ("rate_date", _DATE),
        ("exchange_rate", _DOUBLE),
        ("created_at", _STAMP),
    )
)

BAR_FILE = T.StructType(
    _fields(
        ("symbol_id", _LONG),
        ("date", _DATE),
        *((c, _DOUBLE) for c in PRICE_COLUMNS),
        ("volume", _LONG),
    )
)

ETF_DATA = T.StructType(
    _fields(("id", _LONG))
    + BAR_FILE.fields
    + _fields(*((c, _DOUBLE) for c in EUR_COLUMNS), ("created_at", _STAMP))
)

METRICS = T.StructType(
    _fields(
        ("id", _LONG),
        ("symbol_id", _LONG),
        ("calculation_date", _DATE),
        ("high_52week", _DOUBLE),
        ("low_52week", _DOUBLE),
        ("high_date", _DATE),
        ("low_date", _DATE),
        ("created_at", _STAMP),
    )
)

THRESHOLDS = T.StructType(
    _fields(
        ("id", _LONG),
        ("symbol_id", _LONG),
        ("calculation_date", _DATE),
        ("high_52week_price", _DOUBLE),
        *((f"decrease_{n}_price", _DOUBLE) for n in LEVELS),
        ("created_at", _STAMP),
    )
)

HOLDINGS = T.StructType(
    _fields(
        ("holder", _LONG),
        ("symbol_id", _LONG),
        ("country", _TEXT),
        ("units", _LONG),
        ("cost", _DOUBLE),
    )
)

MART_FX_RATES = T.StructType(
    _fields(
        ("from_currency", _TEXT),
        ("to_currency", _TEXT),
        ("rate_date", _DATE),
        ("exchange_rate", _DOUBLE),
    )
)

SYMBOL_STATE = T.StructType(
    _fields(
        ("symbol_id", _LONG),
        ("first_date", _DATE),
        ("latest_date", _DATE),
        ("last_close", _DOUBLE),
        ("peak_close", _DOUBLE),
        ("rows", _LONG),
        ("max_id", _LONG),
    )
)

RAW_TABLES = {
    "symbols": SYMBOLS,
    "currency_rates": CURRENCY_RATES,
    "etf_data": ETF_DATA,
    "fifty_two_week_metrics": METRICS,
    "decrease_thresholds": THRESHOLDS,
    "holdings": HOLDINGS,
    "symbol_state": SYMBOL_STATE,
}

_STEP = T.StructType(
    _fields(
        ("start_time", _TEXT),
        ("end_time", _TEXT),
        ("duration", _DOUBLE),
        ("success", T.BooleanType()),
        ("error", _TEXT),
    )
)

RUN_LOG = T.StructType(
    _fields(
        ("run_id", _LONG),
        ("workflow_start", _TEXT),
        ("workflow_end", _TEXT),
        ("overall_duration", _DOUBLE),
        ("overall_success", T.BooleanType()),
        ("steps", T.MapType(_TEXT, _STEP)),
        ("errors", T.ArrayType(_TEXT)),
    )
)

_BAR_ENTRY = T.StructType(
    _fields(
        ("date", _DATE),
        *((c, _DOUBLE) for c in PRICE_COLUMNS),
        ("volume", _LONG),
        *((c, _DOUBLE) for c in EUR_COLUMNS),
    )
)

SYMBOL_DOCUMENT = T.StructType(
    [
        T.StructField(
            "symbol",
            T.StructType(
                _fields(
                    ("id", _LONG),
                    ("name", _TEXT),
                    ("ticker", _TEXT),
                    ("isin", _TEXT),
                    ("nativeCurrency", _TEXT),
                )
            ),
        ),
        T.StructField("priceData", T.ArrayType(_BAR_ENTRY)),
        T.StructField(
            "metrics",
            T.StructType(
                _fields(
                    ("high52week", _DOUBLE),
                    ("low52week", _DOUBLE),
                    ("highDate", _DATE),
                    ("lowDate", _DATE),
                    ("calculationDate", _DATE),
                )
            ),
        ),
        T.StructField(
            "thresholds",
            T.ArrayType(
                T.StructType(
                    _fields(
                        ("percentage", T.IntegerType()),
                        ("thresholdPrice", _DOUBLE),
                        ("calculationDate", _DATE),
                    )
                )
            ),
        ),
        T.StructField("lastUpdated", _STAMP),
    ]
)
