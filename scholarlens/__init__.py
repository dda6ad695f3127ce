"""scholarlens: a PySpark-native engine for academic-record data."""
