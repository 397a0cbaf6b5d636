"""DataFrame to DataFrame operators, for use through ``DataFrame.transform``."""
