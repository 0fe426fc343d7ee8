"""Reading landed payloads; reading and publishing tables."""
