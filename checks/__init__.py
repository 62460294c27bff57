"""Derived inputs, registered queries and their SQL counterparts, used by tests, bench and driver."""
