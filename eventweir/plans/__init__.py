"""Topic configuration and the compositions built from it."""
