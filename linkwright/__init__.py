"""Linked work records on Spark: tables to graph, text to vectors, changes to messages."""
