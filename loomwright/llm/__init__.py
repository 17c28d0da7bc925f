"""Operators that turn raw text and pages into training data."""
