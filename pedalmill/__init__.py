"""pedalmill: a Spark-first analytics engine for order and sales data."""
