"""Reusable DataFrame operators that stay balanced when one key is very large."""
