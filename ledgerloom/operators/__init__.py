"""DataFrame -> DataFrame operators; statistics are grouped by snapshot."""
