"""timbrelake: a PySpark-native engine for feature tables of large file collections."""
