"""Generic DataFrame operators; nothing here knows about flights."""
