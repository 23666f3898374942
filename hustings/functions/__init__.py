"""Column functions for names, texts, dates and markup."""
