"""Training-data operators. Nothing else in the repository imports this subpackage."""
