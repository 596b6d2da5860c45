"""ledgerlens: transaction-risk analytics on Spark.

Operators are functions DataFrame -> DataFrame grouped by stage:

* `ledgerlens.operators.quality`   gates, profiles, validity reports, cleaning (Q*)
* `ledgerlens.operators.enrich`    account roll-up, profile join, context columns (J*, E*)
* `ledgerlens.operators.explore`   exploratory aggregates (A*)
* `ledgerlens.operators.features`  row features, causal velocity, one-hots (FE*)
* `ledgerlens.operators.prep`      splits, scaling, resampling, selection (T*)
* `ledgerlens.operators.ranks`     distributed ranks, running sums, exact quantiles
* `ledgerlens.operators.evaluate`  threshold sweep, AP, ROC-AUC, budgets (M6-M21)
* `ledgerlens.operators.train`     Spark ML fits, tuning, selection, policy (M1-M5, M14-M24)
* `ledgerlens.operators.smote`     SMOTE with exact blocked k-NN (T12)
* `ledgerlens.operators.score`     decision policy, risk signals, queues (P*)
* `ledgerlens.operators.monitor`   drift, rolling metrics, triggers (MN*)
* `ledgerlens.streaming`           keyed-state velocity, streaming scorer, ingest, windows
* `ledgerlens.sources`             table readers / sinks, event log, the test stand-in view

Named queries live in `ledgerlens.plans` (see `__spark_entry__.queries()`).
"""

__version__ = "0.1.0"
