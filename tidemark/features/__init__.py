"""Point-in-time features of prices, flows, filings, fundamentals and macro series."""
