"""Layer jobs composed from the operators, and the registered queries."""
