"""Skein: a PySpark-native engine for citation analytics over structured regulatory text."""
