"""Jobs: compositions of the operators, driven by plain spec values."""
