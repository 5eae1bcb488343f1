"""Table contracts, loaders, sinks and artifacts."""
