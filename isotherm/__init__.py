"""isotherm: Spark-native analytics for monthly observation data.

Every operator is a plain ``DataFrame -> DataFrame`` function whose column
names and thresholds are parameters.  Work runs inside Catalyst (no Python
UDFs on the hot path); only metric-sized frames ever reach the driver.
"""

__version__ = "0.1.0"
