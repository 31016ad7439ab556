"""Network-flow analytics on Spark: flows, cleaning, sampling, scoring and security roll-ups."""
