"""Model pipelines, training runs and the registered queries."""
