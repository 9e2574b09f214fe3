"""Running totals over file streams."""
