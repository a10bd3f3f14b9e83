"""The question catalogue, its SQL checks, and the batch that builds the derived tables."""
