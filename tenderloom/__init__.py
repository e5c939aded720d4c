"""Public-tender analytics as Spark DataFrame operators."""
