"""maintspark: predictive-maintenance analytics as Spark DataFrame and stream operators.

Every operator takes and returns DataFrames; nothing is collected to the driver
except small, bounded control tables (per-day counts, per-partition totals).
"""

__version__ = "0.1.0"
