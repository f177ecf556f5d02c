"""The library's tables as queries over the driver's test tables."""
