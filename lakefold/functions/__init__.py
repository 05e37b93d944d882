"""Column functions: ``Column -> Column``, built-in expressions only."""

from lakefold.functions import clean, logtext

__all__ = ["clean", "logtext"]
