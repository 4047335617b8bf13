"""Reading action logs and matrices, writing the published tables."""
