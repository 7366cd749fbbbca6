"""changelake: a PySpark-native change-data engine (see README.md)."""
