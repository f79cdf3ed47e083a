"""Sales and subscription revenue analytics on Spark DataFrames."""

from dealglass.model import Model

__all__ = ["Model"]
