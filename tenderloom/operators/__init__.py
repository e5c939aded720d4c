"""Table operators, ``DataFrame -> DataFrame``."""
