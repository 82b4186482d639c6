"""Change events: normalise, route, and apply as a stream or a batch."""
