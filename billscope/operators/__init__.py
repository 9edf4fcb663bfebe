"""DataFrame operators the report plans are composed of."""
