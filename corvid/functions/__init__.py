"""Column-expression helpers (FN): built-in Spark functions only, so every expression
stays inside whole-stage codegen."""
