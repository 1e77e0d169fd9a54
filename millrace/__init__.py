"""millrace: user-level data jobs written as Spark DataFrame programs.

Sub-packages
------------
``functions``  Column -> Column helpers (no Python UDFs)
``sources``    files, series, sample data, and table layout (sinks)
``operators``  DataFrame -> DataFrame building blocks
``plans``      whole jobs composed from the operators
``streaming``  Structured Streaming jobs
"""

__version__ = "0.1.0"
