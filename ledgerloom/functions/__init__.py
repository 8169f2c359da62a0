"""Column builders: no UDFs, everything stays in whole-stage codegen."""
