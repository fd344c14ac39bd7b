"""Registered queries and their SQL counterparts, by section of the inventory."""
