"""Ready-made feature workflows."""
