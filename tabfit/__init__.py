"""tabfit: tabular feature engineering, boosted trees, tuning and metrics as Spark jobs.

Sub-packages:

* ``sources``   - typed CSV / libsvm readers with a bad-row policy, model storage
* ``functions`` - Column-level helpers (date parts, sentinels, metric expressions)
* ``operators`` - DataFrame-in / DataFrame-out operators (encoders, statistics,
  histogram boosting, evaluation, tuning)
* ``plans``     - the full feature frames and the query catalogue
* ``streaming`` - Structured Streaming scoring with a saved model
"""

__version__ = "0.1.0"
