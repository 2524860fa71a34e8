"""Column builders: quantization, geometry, identities."""
