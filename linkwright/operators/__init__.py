"""Set-based operators over records, graphs, text and vectors."""
