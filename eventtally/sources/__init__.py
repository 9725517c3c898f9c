"""Readers: event topics, the serving table and tab-separated metric files."""
