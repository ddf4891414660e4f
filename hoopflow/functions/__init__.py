"""Part of hoopflow."""
