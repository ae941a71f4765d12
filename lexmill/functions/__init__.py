"""Column functions and the few Arrow UDFs that the built-in functions cannot express."""
