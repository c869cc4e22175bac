"""A PySpark-native engine for typed evidence graphs over nested extraction records."""
