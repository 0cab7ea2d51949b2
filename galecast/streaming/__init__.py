"""The polling loop as streams."""
