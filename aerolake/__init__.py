"""Aircraft state-vector analytics expressed as Spark DataFrame operators."""
