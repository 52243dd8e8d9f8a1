"""Feed readers, feed layouts and table sinks."""
