"""Feed schemas, feature registry and the constants the calculations depend on."""

from __future__ import annotations

from pyspark.sql import types as T

_D, _F, _S, _I, _L = T.DoubleType(), T.FloatType(), T.StringType(), T.IntegerType(), T.LongType()


def _schema(**fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


# The four feed schemas.
TRADES = _schema(
    timestamp=_D, trdMatchID=_S, symbol=_S, price=_F, size=_I, homeNotional=_D,
    foreignNotional=_D, side=_S, tickDirection=_S, grossValue=_L,
)
ORDERBOOK = _schema(timestamp=_D, id=_L, symbol=_S, side=_S, price=_F, size=_I, action=_S)
LIQUIDATIONS = _schema(
    timestamp=_D, orderID=_S, symbol=_S, side=_S, orderQty=_I, price=_F, leavesQty=_I,
    cumQty=_I, ordType=_S, timeInForce=_S,
)
INSTRUMENTS = _schema(
    timestamp=_D, symbol=_S, openInterest=_L, fundingRate=_D, indicativeFundingRate=_D,
    fundingTimestamp=_D, markPrice=_F, indexPrice=_F, settlementPrice=_F, volume24h=_L,
    turnover24h=_D,
)
FEEDS = {
    "trades": TRADES,
    "orderbook": ORDERBOOK,
    "liquidations": LIQUIDATIONS,
    "instruments": INSTRUMENTS,
}
# Message table name of each feed, and the dedup key of each feed.
MESSAGE_TABLES = {
    "trade": "trades",
    "orderBookL2": "orderbook",
    "liquidation": "liquidations",
    "instrument": "instruments",
}
DEDUP_KEYS = {
    "trades": ["trdMatchID"],
    "orderbook": ["id", "timestamp"],
    "liquidations": ["orderID"],
    "instruments": ["symbol", "timestamp"],
}

# Trade weight by tick direction; any other direction weighs 1.
TICK_WEIGHTS = {"PlusTick": 1.5, "ZeroPlusTick": 1.5, "MinusTick": -1.5, "ZeroMinusTick": -1.5}

# Feature id -> name.
FEATURES = {
    0: "Price vs. Slow EMA (5min)",
    1: "Mid-Price (Log Return)",
    2: "Relative Spread",
    3: "Multi-Level Cumulative OBI",
    4: "Taker Imbalance",
    5: "Realized Volatility (dt)",
    6: "Multi-Level WAP",
}
TARGET_FEATURE = 0
PNL_FEATURE = 1
CLUSTER_FEATURES = [2, 3, 4, 5, 6]

# Z-score thresholds (default, per feature, per feature and symbol), round limit.
Z_DEFAULT = 15.0
Z_FEATURE = {
    "Price vs. Slow EMA (5min)": 15.0,
    "Multi-Level WAP": 4.0,
    "Mid-Price (Log Return)": 60.0,
    "Relative Spread": 30.0,
    "Realized Volatility (dt)": 30.0,
}
Z_FEATURE_SYMBOL = {("Multi-Level WAP", "ADAUSDT"): 2.0}
Z_FEATURES = [0, 1, 2, 5, 6]
Z_ROUNDS = 5

# Feature and regime defaults.
STEP_MS = 100
DEPTH = 15
EMA_SPAN = 3000
VOL_WINDOW = 50
RETURN_CLIP = 0.1
RANK_WINDOW = 3600
RANK_MIN = 360
SEGMENT = "10 minutes"
TARGET_REGIMES = 5
MAX_REGIMES = 20
MAX_NOISE = 0.3
MIN_REGIME_SIZE = 5
N_NEIGHBORS = 15
MIN_CLUSTER_SIZE = 30
MIN_SAMPLES = 10

# Data-quality rules, name -> (feed, limit).
QUALITY_RULES = {
    "min_trades_per_minute": ("trades", 10.0),
    "max_price_change_pct": ("trades", 5.0),
    "max_trade_latency_ms": ("trades", 100.0),
    "duplicate_trade_threshold": ("trades", 10.0),
    "min_updates_per_minute": ("orderbook", 100.0),
    "max_spread_pct": ("orderbook", 1.0),
    "max_book_latency_ms": ("orderbook", 50.0),
    "max_liquidations_per_minute": ("liquidations", 1000.0),
    "min_liquidation_size": ("liquidations", 1.0),
    "max_funding_rate": ("instruments", 0.01),
    "min_update_interval": ("instruments", 1.0),
}
