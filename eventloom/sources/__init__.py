"""Feed files, landing partitions and warehouse tables."""
