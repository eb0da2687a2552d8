"""Keyed tables (upsert / insert-ignore), append guards and exports."""
