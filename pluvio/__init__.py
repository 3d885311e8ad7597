"""pluvio: data-quality audit, imputation and classification operators on Spark DataFrames."""

from .config import WEATHER, Roles

__all__ = ["Roles", "WEATHER"]
