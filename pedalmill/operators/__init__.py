"""operators of pedalmill."""
