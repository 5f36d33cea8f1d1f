"""Readers: landed feed documents, the message log, stored tables."""
