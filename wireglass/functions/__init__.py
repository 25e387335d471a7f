"""Column functions: attribute types, HTTP fields and JSON rendering."""
