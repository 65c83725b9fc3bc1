"""Sources and sinks: entity CSV files, the driver tables."""
