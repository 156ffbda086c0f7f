"""Chatterloom: conversation analytics as declarative Spark plans."""
