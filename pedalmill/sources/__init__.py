"""sources of pedalmill."""
