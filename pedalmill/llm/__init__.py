"""Operators for training-data pipelines over names, addresses and texts; nothing else here imports them."""
