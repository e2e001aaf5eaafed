"""Named queries and the driver's plans."""
