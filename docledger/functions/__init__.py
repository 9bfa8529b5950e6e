"""Column functions: cleaning, text extraction, validation."""
