"""Ready-made jobs and the registered queries."""
