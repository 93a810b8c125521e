"""quillspark: a PySpark-native analytics engine for text memory stores.

Every operator is a function from DataFrames to a DataFrame; the planner and
the shuffle service do the rest.  Sub-packages:

``functions``  pure ``Column`` builders (text, scoring, vectors, hashing, time)
``operators``  composable relational, vector, graph and gate operators
``sources``    table schemas, Parquet loading and the adapter views
``plans``      the eight end-to-end jobs built from operators
``streaming``  Structured Streaming variants of the incremental jobs
"""

__version__ = "0.1.0"
