"""Column helpers: text, semi-structured records, document titles, Markdown."""
