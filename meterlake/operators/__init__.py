"""DataFrame -> DataFrame operators.  Chain them with ``DataFrame.transform``."""
