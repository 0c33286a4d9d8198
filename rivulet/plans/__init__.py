"""Configuration, whole pipelines and the registered queries."""
