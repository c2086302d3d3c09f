"""The library applied to the driver's tables."""
