"""clickstar: a PySpark-native web-analytics warehouse.

Nested, date-partitioned event exports become flat events, sessions and users,
then a star schema, marts, dashboard metrics, quality checks and audit reports.
"""

__version__ = "0.1.0"
