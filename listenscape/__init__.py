"""listenscape: audience feature matrices from listening logs, as Spark DataFrame plans."""

__version__ = "0.1.0"
