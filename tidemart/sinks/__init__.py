"""Writers: stream tables, Gold datasets, warehouse tables."""
