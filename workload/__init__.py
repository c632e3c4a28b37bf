"""The queries the engine is checked and timed with, and their SQL counterparts."""
