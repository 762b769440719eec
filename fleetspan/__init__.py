"""Fleet telemetry analytics as Spark jobs.

Captured outputs of a server fleet (bodies, documents, log lines, readings,
traps, configuration, listings) go in as DataFrames or streams; typed
measurements, availability, events, rates and inventory come out.
"""

__version__ = "0.1.0"
