"""Readers and writers; jobs start from landed files and end in Spark tables."""
