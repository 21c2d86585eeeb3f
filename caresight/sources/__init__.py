"""Table loaders, reference-shaped adapters over the test tables, and report sinks."""
