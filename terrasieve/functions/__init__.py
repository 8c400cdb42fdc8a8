"""Part of terrasieve."""
