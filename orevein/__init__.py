"""orevein: classic data-mining operators as plain Spark DataFrame functions."""
