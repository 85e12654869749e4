"""Event-time metrics over late and out-of-order sensor data, on Spark."""
