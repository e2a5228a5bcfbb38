"""reviewlake: review/event-stream analytics as Spark DataFrame operators.

Every operator is a plain ``DataFrame -> DataFrame`` function built from
Spark SQL / DataFrame primitives, so Catalyst plans it, AQE re-plans it at
run time, and nothing row-level passes through the driver.
"""

__version__ = "0.1.0"
