"""punctual: a PySpark-native analytics engine for service-reliability data."""
