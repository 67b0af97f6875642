"""Column expression builders: distances, activations, losses, seeded hashing."""
