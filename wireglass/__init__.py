"""wireglass: web and message traffic as DataFrames.

Captured requests, responses, tuples and WebSocket frames are tables (batch) or
file streams; every capability is a function from DataFrame to DataFrame.
"""

__version__ = "0.1.0"
