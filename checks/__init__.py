"""The registered queries: domain tables derived from the given ones, and their SQL twins."""
