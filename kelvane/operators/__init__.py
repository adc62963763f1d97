"""Transforms from DataFrame to DataFrame, for static and streaming input alike
unless a function says otherwise."""
