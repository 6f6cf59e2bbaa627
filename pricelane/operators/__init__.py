"""DataFrame -> DataFrame operators, for use with ``df.transform``."""
