"""Operators that stay distributed whatever the size of one key."""
