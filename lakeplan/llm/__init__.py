"""Training-data operators on document tables; nothing outside this package imports it."""
