"""quipu: multi-country commercial reporting as plain PySpark DataFrame functions."""

__version__ = "0.1.0"
