"""Job specifications and the registered query catalog."""
