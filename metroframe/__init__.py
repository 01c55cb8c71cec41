"""metroframe: city-operations analytics expressed as Spark DataFrame plans.

Every operator is a function ``DataFrame -> DataFrame`` built from
``pyspark.sql.functions`` so Catalyst optimises the whole pipeline and
executors do all row work. See README.md for the module map.
"""

__version__ = "0.1.0"
