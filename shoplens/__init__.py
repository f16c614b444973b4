"""Retail order analytics as plain Spark DataFrame operators.

Layers: ``sources`` read tables (CSV under a declared schema, stored tables,
test fixtures), ``operators`` turn DataFrames into DataFrames (enrichment,
quality, features, models), ``sinks`` store them, ``plans`` chain the layers
over a storage root, ``streaming`` loads new source files incrementally.
"""

__version__ = "0.1.0"
