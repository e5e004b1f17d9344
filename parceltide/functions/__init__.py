"""Column expressions: every derivation runs JVM-side inside whole-stage codegen."""
