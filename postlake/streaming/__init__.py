"""Structured Streaming jobs. Each runs over what has arrived and stops; run again to go on."""
