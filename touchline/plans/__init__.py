"""Football models and reads: thin compositions of the generic operators."""
