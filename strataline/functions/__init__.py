"""Column-level building blocks, all inside whole-stage codegen."""
