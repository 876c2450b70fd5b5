"""Column functions: cleaning, calendar rules, labels and display text."""
