"""gradientlab: DataFrame operators for multi-site ecological gradient experiments."""

__version__ = "0.1.0"
