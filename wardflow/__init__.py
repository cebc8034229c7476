"""wardflow: Spark-native cohort and time-series analytics.

Modules
-------
session            session settings, checkpoint folder, cluster sizing, shipping to executors
sources.io         readers and writers (parquet, feature-file folders, delimited, JSON, JDBC)
functions.scalar   built-in scalar expressions (time deltas, parsing, erf, t quantile, ...)
operators.panel    trimmed hourly reduction, class-wise pivots, grids, re-origin, trims
operators.sequence fills, interpolations, leave-one-out estimates, islands, windows, rates
operators.asof     forward as-of attribution of events to stays
operators.stats    prefix sums, quantiles, AUC / PR, calibration, agreement, profiles
operators.masking  hash masks, simple imputers, error metrics
operators.models   splits, encoders, series features, chained imputation, MLlib helpers
operators.dtw      DTW k-medoids
plans              registered queries and their SQL oracles
streaming.hourly   watermarked hourly bins of a measurement stream
"""

__version__ = "0.1.0"
