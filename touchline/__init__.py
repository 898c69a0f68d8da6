"""touchline: sports, sales, image and sensor analytics as Spark DataFrame jobs.

Every operator is a plain ``DataFrame -> DataFrame`` function built from
built-in Spark SQL expressions, so Catalyst can prune columns, push filters
into the scan and keep the work inside whole-stage code generation.
"""

__version__ = "0.1.0"
