"""Relational operators: validation, carts, change tracking, audit, views."""
