"""Jobs and brand profiles made of the operators."""
