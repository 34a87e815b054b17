"""DataFrame operators: joins (D), aggregation (E), series windows (F1-F15),
forecasting (F16-F18) and set operations (G).  ``series`` holds the
skew-safe building blocks the series operators share."""
