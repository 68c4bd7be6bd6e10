"""Column functions: each takes and returns ``Column`` objects and stays inside codegen."""
