"""Jobs that compose the operators, and the query catalog."""
