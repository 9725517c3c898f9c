"""Writers: raw events, topics, batch logs, the serving table and dead letters."""
