"""Jobs made of several operators, and the registry of named queries."""
