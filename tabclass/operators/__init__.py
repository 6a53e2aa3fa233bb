"""DataFrame operators: columns, rows, quantiles, features, splits, metrics."""
