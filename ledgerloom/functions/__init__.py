"""Column -> Column building blocks; all stay inside whole-stage codegen."""
