"""Jobs that chain the operators: pipeline stages and run history."""
