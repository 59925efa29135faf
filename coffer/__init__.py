"""coffer: retail-banking and payments analytics as lazy Spark DataFrame operators."""
