"""Training-data pipeline operators: token counts, filters, de-duplication, formatting, packing, sharding."""
