"""DataFrame operators, grouped by stage of the classification workflow."""
