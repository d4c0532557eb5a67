"""Column -> Column building blocks; all of them stay inside whole-stage codegen."""
