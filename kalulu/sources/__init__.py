"""Table readers / writers and the projection of the driver tables."""
