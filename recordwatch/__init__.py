"""Spark-native analytics for monitored records: diffs, lifecycles, alerts, dedup, rules and reports."""
