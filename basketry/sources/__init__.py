"""Table schemas, readers, sinks, and the adapter views over the star-schema test tables."""
