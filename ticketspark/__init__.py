"""Spark-native analytics for city enforcement events.

Every operator is a function from DataFrame to DataFrame (or a Column builder)
and stays lazy unless its docstring says otherwise.
"""

__version__ = "0.1.0"
