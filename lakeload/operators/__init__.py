"""DataFrame operators of the warehouse load."""
