"""Column functions: every one is a native expression, so plans stay in whole-stage codegen."""
