"""Jobs composed of the operators, their command line, and the registered queries."""
