"""Reading and writing: captured responses, request planning, batch-partitioned tables."""
