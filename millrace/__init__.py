"""Analytics over large fact tables and event logs, as plain Spark DataFrame functions."""
