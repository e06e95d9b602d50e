"""Registered queries bound to the driver tables, with their SQL oracles."""
