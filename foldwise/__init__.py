"""foldwise: k-fold tabular regression on Spark DataFrames.

Sources and sinks (``sources``), column helpers (``functions``), operators
(encoding, scaling, folds, moments, linear models, trees, metrics), plans
(training table, grid search, scoring, end-to-end programs) and streamed
scoring (``streaming``).
"""

__version__ = "0.1.0"
