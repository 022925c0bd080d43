"""Plan-level building blocks (fused multi-column aggregation, distributed ordered scans),
the input bindings used by the query catalog, and the catalog itself."""
