"""streaming of pedalmill."""
