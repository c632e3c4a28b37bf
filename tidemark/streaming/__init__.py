"""Event streams: engagement, de-duplication, sessions, upserts, anomalies, late events."""
