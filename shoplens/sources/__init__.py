"""Sources: CSV under a declared schema, stored tables, file listings, test fixtures."""
