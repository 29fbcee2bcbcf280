"""Column helpers with the number, date and text rules of the loyalty data."""
