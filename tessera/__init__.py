"""tessera: a PySpark-native engine for binned, stateful analyses of simulation records."""

__version__ = "0.1.0"
