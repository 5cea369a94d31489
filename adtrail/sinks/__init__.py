"""Writers: message topics, curated tables and dead-letter tables."""
