"""Delivery-operations analytics as plain functions from DataFrames to DataFrames.

Layout: ``functions`` (column helpers), ``operators`` (frame in, frame out),
``sources`` (reading and writing), ``plans`` (end-to-end tables and reports),
``streaming`` (Structured Streaming forms), ``rules`` (fixed business values).
"""

__version__ = "0.1.0"
