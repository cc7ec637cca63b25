"""Change-data-capture and clickstream lakehouse on Spark: raw, current-state and star-schema layers."""
