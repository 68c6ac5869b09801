"""Fixed values of the application."""

# Per index: which table of its page lists the members, and under which headers.
INDEX_PAGES = {
    "S&P500": (0, "Symbol", "Security", "GICS Sector"),
    "NASDAQ": (4, "Ticker", "Company", "GICS Sector"),
}

# Stocks a provider lets one client subscribe to.
SUBSCRIPTION_LIMIT = 50

# Symbols listed first.
FIRST_SYMBOLS = 10

# Seconds between two moves, and the age at which a trade moves.
MOVE_SECONDS = 60

# Seconds between two refreshes of a chart.
REFRESH_SECONDS = 5
# How long a read of the hot table may take.
RETENTION_SECONDS = 3600
DAY_MS = 86_400_000
