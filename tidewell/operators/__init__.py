"""DataFrame-to-DataFrame operators on change records."""
