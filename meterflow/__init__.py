"""meterflow: smart-meter telegrams to change messages to raw tables, on Spark.

Every stage is a function DataFrame -> DataFrame made of built-in Spark
expressions; only the streaming form of change detection keeps per-meter state
in a grouped pandas function.
"""

__version__ = "0.1.0"
