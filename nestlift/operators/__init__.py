"""DataFrame -> DataFrame operators: enforce, unnest, upsert, load-time filters."""
