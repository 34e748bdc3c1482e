"""Column functions: rates and flags, text parsing, classification rules."""
