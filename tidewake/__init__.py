"""AIS port-call analytics and related data processing on Spark."""
