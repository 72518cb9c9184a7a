"""Model builds and the two end-to-end flows."""
