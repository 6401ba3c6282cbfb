"""Publishing from a stream."""
