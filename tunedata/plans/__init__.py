"""End-to-end plans and the registered driver queries."""
