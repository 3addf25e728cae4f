"""Column expressions. All of them are built-ins, so they stay in codegen."""
