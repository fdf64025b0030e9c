"""Multi-step plans and the registry of named queries."""
