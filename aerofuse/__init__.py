"""Air-quality fusion and PM2.5 modelling as Spark DataFrame operations."""

__version__ = "0.1.0"
