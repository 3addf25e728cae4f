"""Jobs: the operators in order, with their gates."""
