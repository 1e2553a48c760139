"""Analytics as functions from a packet DataFrame to a result DataFrame."""
