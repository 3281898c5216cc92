"""Composed plans: the layered build, the registered queries with their
oracle SQL, and plan-inspection helpers."""
