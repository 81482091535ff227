"""Lakehouse analytics for public code-hosting events, written as plain Spark jobs.

Every operator takes DataFrames and returns a DataFrame; ``plans`` chains them
into the hourly and daily jobs over a :class:`repopulse.sinks.lake.Lake`.
"""
