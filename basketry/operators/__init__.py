"""DataFrame-to-DataFrame building blocks: quantiles, ordered features, encoders, statistics."""
