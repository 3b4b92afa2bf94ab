"""Part of the quarrymill engine."""
