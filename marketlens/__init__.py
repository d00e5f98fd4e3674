"""Product price and sales analytics as Spark DataFrame operators."""
