"""Ready-made pipelines built from the operators."""
