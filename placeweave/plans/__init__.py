"""Jobs and test plans made of operators."""
