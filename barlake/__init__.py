"""A price-bar lake on Spark: landing files in, checked and published bars out."""

__version__ = "0.1.0"
