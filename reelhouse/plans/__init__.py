"""Plans: stand-in tables over the driver data, layer pipelines, query registry."""
