"""Spark-native pipelines for audited lakehouse tables.

Sub-packages: ``sources`` (reading), ``functions`` (column expressions),
``operators`` (DataFrame to DataFrame building blocks), ``plans`` (the named
tables and the publish protocol) and ``streaming`` (Structured Streaming jobs).
"""

__version__ = "0.1.0"
