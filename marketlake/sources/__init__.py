"""Readers for landed report files and small dimensions."""
