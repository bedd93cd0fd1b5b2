"""tributary: a Spark-native change-event lakehouse.

Raw change events (Kafka or files) are landed as Bronze, parsed and checked
into Silver plus a quarantine, and modelled into a Gold star schema with
serving aggregates. Every step is a DataFrame -> DataFrame function over
built-in Spark expressions.
"""

__version__ = "0.1.0"
