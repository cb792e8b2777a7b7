"""Column names, bounds, windows and model settings.

These must equal the published semantics for results to agree; every function
that uses one takes it as a keyword argument with the value here as default.
"""

# Bars
REQUIRED_COLUMNS = [
    "SNo", "Name", "Symbol", "Date", "High", "Low", "Open", "Close", "Volume", "Marketcap",
]
CRITICAL_COLUMNS = ["Date", "High", "Low", "Open", "Close"]
PRICE_COLUMNS = ["High", "Low", "Open", "Close"]

# Quality bounds
MIN_PRICE = 0.01
MAX_PRICE = 100000.0
MAX_VOLUME = 1e12
MIN_ROWS = 10
MAX_GAP_DAYS = 30
EARLIEST_DATE = "2010-01-01"

# Features
ROLLING_WINDOWS = (5, 10, 20)
TREND_WINDOWS = (5, 10, 20)  # SMA, EMA and momentum keep these whatever ROLLING_WINDOWS is
VOLUME_RATIO_WINDOW = 5
RSI_WINDOW = 14
MACD_SPANS = (12, 26)
MACD_SIGNAL_SPAN = 9
BOLLINGER_WINDOW = 20
BOLLINGER_SDS = 2.0
DAYS_PER_YEAR = 365.25

# Repair
CLIP_QUANTILES = (0.01, 0.99)
CLIP_REACH = 1.5

# Splits
SPLIT_RATIOS = (0.6, 0.2, 0.2)
N_FOLDS = 5

# Model
N_TREES = 100
MAX_DEPTH = 10
MIN_LEAF = 2
SEED = 42
CONFIDENCE = 0.85
MODEL_NAME = "bar-close-forest"
MODEL_VERSION = "1.0.0"
GRID = {
    "numTrees": [50, 100, 200],
    "maxDepth": [5, 10, 15, 30],  # 30 is the deepest tree Spark grows; stands for "no limit"
    "minInstancesPerNode": [1, 2, 4],
}
