"""DataFrame-in, DataFrame-out operators the plans are composed of."""
