"""Lookup data that must hold exactly these entries.

They decide asset names and classes, trading days, look-back lengths and
simulated amounts, so results depend on them literally.
"""

# --- fixed values: equity tickers -> (display name, asset class) -------------
EQUITIES = {
    "AAPL": ("Apple Inc.", "stock"),
    "GOOGL": ("Alphabet Inc.", "stock"),
    "MSFT": ("Microsoft Corporation", "stock"),
    "SPY": ("S&P 500 ETF", "index"),
}

# --- fixed values: rate pairs -> (currency id, display name) -----------------
RATE_PAIRS = {
    "C:EURUSD": ("EUR", "Euro"),
    "C:GBPUSD": ("GBP", "British Pound"),
}

# --- fixed values: benchmark and cash assets --------------------------------
BENCHMARK_ID = "BTC"
BENCHMARK_NAME = "Bitcoin"
CASH_ID = "USD"
CASH_NAME = "US Dollar"

# --- fixed values: asset class -> sort position, report category -------------
CLASS_ORDER = {"crypto": 1, "fiat": 2, "stock": 3, "index": 4}
CLASS_CATEGORY = {
    "fiat": "Fiat Currencies",
    "crypto": "Cryptocurrency",
    "stock": "Stocks",
    "index": "Market Index",
}

# --- fixed values: look-back periods in days; None = start of the year -------
REPORT_PERIODS = {"7D": 7, "1M": 30, "3M": 90, "6M": 180, "YTD": None, "1Y": 365}
FIGURE_PERIODS = {"7D": 7, "1M": 30, "3M": 91, "6M": 182, "YTD": None, "1Y": 365}

# --- fixed values: simulated amounts in USD, purchases, trading days a year --
LUMP_SUM_USD = 1000.0
MONTHLY_USD = 100.0
MONTHLY_PURCHASES = 12
TRADING_DAYS_PER_YEAR = 252

# --- fixed values: market holidays (date, name, status) ----------------------
HOLIDAYS = {
    "US": [
        ("2025-01-01", "New Year's Day", "closed"),
        ("2025-01-20", "Martin Luther King Jr. Day", "closed"),
        ("2025-02-17", "Presidents' Day", "closed"),
        ("2025-04-18", "Good Friday", "closed"),
        ("2025-05-26", "Memorial Day", "closed"),
        ("2025-06-19", "Juneteenth", "closed"),
        ("2025-07-04", "Independence Day", "closed"),
        ("2025-09-01", "Labor Day", "closed"),
        ("2025-11-27", "Thanksgiving Day", "closed"),
        ("2025-11-28", "Day After Thanksgiving", "early_close"),
        ("2025-12-24", "Christmas Eve", "early_close"),
        ("2025-12-25", "Christmas Day", "closed"),
        ("2026-01-01", "New Year's Day", "closed"),
        ("2026-01-19", "Martin Luther King Jr. Day", "closed"),
        ("2026-02-16", "Presidents' Day", "closed"),
        ("2026-04-03", "Good Friday", "closed"),
        ("2026-05-25", "Memorial Day", "closed"),
        ("2026-06-19", "Juneteenth Holiday", "closed"),
        ("2026-07-03", "Independence Day Observed", "closed"),
        ("2026-09-07", "Labor Day", "closed"),
        ("2026-11-26", "Thanksgiving Day", "closed"),
        ("2026-11-27", "Thanksgiving Early Close", "early_close"),
        ("2026-12-24", "Christmas Early Close", "early_close"),
        ("2026-12-25", "Christmas Day", "closed"),
    ],
    "UK": [
        ("2025-01-01", "New Year's Day", "closed"),
        ("2025-04-18", "Good Friday", "closed"),
        ("2025-04-21", "Easter Monday", "closed"),
        ("2025-05-05", "Early May Bank Holiday", "closed"),
        ("2025-05-26", "Spring Bank Holiday", "closed"),
        ("2025-08-25", "Summer Bank Holiday", "closed"),
        ("2025-12-25", "Christmas Day", "closed"),
        ("2025-12-26", "Boxing Day", "closed"),
        ("2026-01-01", "New Year's Day", "closed"),
        ("2026-04-03", "Good Friday", "closed"),
        ("2026-04-06", "Easter Monday", "closed"),
        ("2026-05-04", "Early May Bank Holiday", "closed"),
        ("2026-05-25", "Spring Bank Holiday", "closed"),
        ("2026-08-31", "Summer Bank Holiday", "closed"),
        ("2026-12-25", "Christmas Day", "closed"),
        ("2026-12-28", "Boxing Day (Substitute)", "closed"),
    ],
    "EU": [
        ("2025-01-01", "New Year's Day", "closed"),
        ("2025-04-18", "Good Friday", "closed"),
        ("2025-04-21", "Easter Monday", "closed"),
        ("2025-05-01", "Labour Day", "closed"),
        ("2025-12-25", "Christmas Day", "closed"),
        ("2025-12-26", "Boxing Day", "closed"),
        ("2026-01-01", "New Year's Day", "closed"),
        ("2026-04-03", "Good Friday", "closed"),
        ("2026-04-06", "Easter Monday", "closed"),
        ("2026-05-01", "Labour Day", "closed"),
        ("2026-12-25", "Christmas Day", "closed"),
        ("2026-12-26", "Boxing Day", "closed"),
    ],
}

# --- fixed values: currencies and the market whose holidays apply ------------
CURRENCY_MARKET = {"GBP": "UK", "EUR": "EU"}

# --- fixed values: assets to ingest ------------------------------------------
# ticker, name, class, source, resource, enabled, tags, request parameters
CATALOGUE = [
    ("AAPL", "Apple Inc.", "stock", "massive", "stocks", True, ["tech", "sp500", "large_cap"], {}),
    ("GOOGL", "Alphabet Inc.", "stock", "massive", "stocks", True, ["tech", "sp500", "large_cap"], {}),
    ("MSFT", "Microsoft Corporation", "stock", "massive", "stocks", True, ["tech", "sp500", "large_cap"], {}),
    ("SPY", "S&P 500 ETF", "stock", "massive", "stocks", True, ["etf", "sp500", "index"], {}),
    ("C:EURUSD", "EUR/USD", "forex", "massive", "forex", True, ["major_pair", "fiat"], {}),
    ("C:GBPUSD", "GBP/USD", "forex", "massive", "forex", True, ["major_pair", "fiat"], {}),
    ("bitcoin", "Bitcoin", "crypto", "coingecko", "market_chart", True, ["crypto", "btc", "large_cap"],
     {"coin_id": "bitcoin", "vs_currency": "usd"}),
]

# --- fixed values: accepted text forms of a date, tried in this order --------
DATE_FORMATS = ["yyyy-MM-dd", "yyyy/MM/dd", "dd-MM-yyyy"]
