"""Sources: topic logs (Kafka or files), telegram captures, derived fixtures."""
