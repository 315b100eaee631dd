"""evenkeel - fairness auditing and drift monitoring of scored data on Spark.

Every operator takes and returns a ``DataFrame``; nothing is collected to the
driver except model coefficients and one-row checks.
"""

__version__ = "0.1.0"
