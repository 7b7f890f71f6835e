"""passgrid: vehicle-pass analytics for road gantries on PySpark.

Everything is a ``DataFrame -> DataFrame`` function; the same operators take batch and unbounded input.
"""
