"""Readers: snapshots, change feeds, Kafka-shaped records, table lists."""
