"""Registered queries, their oracles and the loan-shaped input they share."""
