"""Sources and sinks: delimited files, JSON batches, layer tables, catalog."""
