"""Analytics over curated text catalogues, on Spark."""
