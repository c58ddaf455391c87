"""Queries put together from the operators, and the SQL that checks them."""
