"""ridelens: trip-log analytics (bike-share rides and similar origin-destination
records) as Spark DataFrame transforms.

Every operator takes and returns a ``DataFrame`` and is built from built-in
``pyspark.sql.functions`` expressions, so Catalyst can push filters and
projections into the scan and whole-stage codegen keeps the work in the JVM.
"""

__version__ = "0.1.0"
