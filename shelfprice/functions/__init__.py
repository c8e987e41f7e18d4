"""Column expressions: all native, no Python workers."""
