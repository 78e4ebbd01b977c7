"""End-to-end jobs built from sources + operators."""
