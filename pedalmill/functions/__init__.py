"""functions of pedalmill."""
