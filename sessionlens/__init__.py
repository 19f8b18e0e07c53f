"""Analytics of long recorded sessions, as PySpark DataFrame operators."""
