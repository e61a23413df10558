"""Column-level functions and the constants they fold into a plan."""
