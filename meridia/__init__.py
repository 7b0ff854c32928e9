"""meridia: a PySpark-native geospatial and corpus analytics engine."""

__version__ = "0.1.0"
