"""Plan-level helpers: sessions, staging, query registry."""
