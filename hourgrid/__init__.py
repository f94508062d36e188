"""Dense hourly activity tables from interval, event and parent/child logs, on Spark."""
