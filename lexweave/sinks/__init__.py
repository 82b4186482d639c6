"""Writers: overwrite, append, keyed upsert, warehouse tables."""
