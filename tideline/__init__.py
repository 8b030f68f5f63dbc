"""tideline: market-event analytics as Spark DataFrame operators."""
