"""Raw sources, landing area and event store."""
